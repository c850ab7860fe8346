"""Interaction audit of document filters by the Hart-Mas-Colell potential of their removal game.

The players are the filters; the worth v(S) of a coalition S is the number of documents that the
filters in S remove together, those that fail at least one of them. The potential of a coalition is
P(S) = (v(S) + sum of P(S without i) over i in S) / |S|, with P() = 0, computed from the empty
coalition upwards. The Shapley value of a filter, its removals averaged over all orders, is
P(all) - P(all without it). What a filter removes at a step of an order is the difference of the
worths of two coalitions. All potentials are kept times |S|!, so that every number is an integer.

Plan: one map over the whole texts gives each document the set of filters that it fails (a bit mask)
and a digest; texts go no further. Labels join by id. Whether a text stands at a smaller id is found
from counts: rows are first counted per digest, mask, part and label, so that a group of copies,
however large, is a handful of rows before its digest is dealt to a task. Each part's 32 counts then
give its rows.

Defined results: a null text is empty. A null part is the empty string. Rows with a null id have no
smaller id and are none. Rows that repeat an id count each; they aren't copies of one another. Of
several labels of one id the greatest counts, a missing or null one counts as 0. Labels without a
document, and other columns, are not read. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import table

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
#: The signs that filter D looks for.
SIGNS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
COPY = FILTERS.index("E")

COUNTS = ["n", "n_good", "n_toxic"]
SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long,"
    " unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_mask(text: bytes, n_chars: int) -> int:
    """Bits of the filters A to D that a text fails."""
    # bytes.split without an argument cuts at the six blanks of the contract
    words = text.split()
    short = len(words) < LEAST_WORDS
    repetitive = 100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    loud = 100 * capitals > MOST_CAPITALS_PERCENT * n_chars
    marked = len(text.translate(None, SIGNS)) < len(text)
    return short | repetitive << 1 | loud << 2 | marked << 3


def judged(docs: DataFrame, part_col: str = "lang") -> DataFrame:
    """Per row of `docs`: doc_id, part, mask of the filters A to D, digest of the text."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.encode() for t in batch["text"]]
            masks = [text_mask(raw, len(t)) for raw, t in zip(texts, batch["text"], strict=True)]
            digests = [hashlib.sha256(raw).digest() for raw in texts]
            out = batch[["doc_id", "part"]]
            yield out.assign(mask=np.array(masks, np.int32), digest=digests)

    wanted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # nullable ids come as floats in pandas; as text they stay whole
    wanted = wanted.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = wanted.mapInPandas(rows, "doc_id string, part string, mask int, digest binary")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def fail_counts(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """Per part and set of failed filters: number of documents, good and toxic ones among them."""

    def mark(column: str):
        return F.max(F.coalesce((F.col(column) == 1).cast("int"), F.lit(0))).alias(column)

    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
    marks = marks.groupBy("doc_id").agg(mark("quality"), mark("toxic"))
    rows = judged(docs, part_col).join(marks, "doc_id", "left").fillna(0, ["quality", "toxic"])

    # copies share digest and mask; what is left of a group is one row per part and label
    alike = ["digest", "part", "mask", "quality", "toxic"]
    by_id = rows.groupBy("doc_id", *alike).agg(F.count("*").alias("n"))
    has_id = F.col("doc_id").isNotNull()
    groups = by_id.groupBy(*alike).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~has_id, F.col("n"))), F.lit(0)).alias("n_null"),
        F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("first"),
    )
    least = F.min("first.doc_id").alias("least")
    listed = F.collect_list(F.struct("part", "mask", "quality", "toxic", "n", "n_null", "first"))
    groups = groups.groupBy("digest").agg(least, listed.alias("rows"))
    groups = groups.select("least", F.inline("rows"))

    leads = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n"))
    unique = F.col("n_null") + F.coalesce(leads, F.lit(0))
    sides = F.array(
        F.struct(F.col("mask").alias("mask"), unique.alias("n")),
        F.struct((F.col("mask") + (1 << COPY)).alias("mask"), (F.col("n") - unique).alias("n")),
    )
    dealt = groups.select("part", "quality", "toxic", F.inline(sides)).filter("n > 0")
    return dealt.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("quality")).alias("n_good"),
        F.sum(F.col("n") * F.col("toxic")).alias("n_toxic"),
    )


def worths(mask: np.ndarray, n: np.ndarray) -> np.ndarray:
    """v(S) for each coalition S, a bit mask: documents that fail a filter in S."""
    coalitions = np.arange(1 << len(FILTERS))
    return ((coalitions[:, None] & mask[None, :]) != 0) @ n


def potentials(worth: np.ndarray) -> list[int]:
    """P(S) times |S|! of each coalition, each from those with one filter less."""
    scaled = [0] * len(worth)
    for coalition in range(1, len(worth)):
        members = [1 << i for i in range(len(FILTERS)) if coalition >> i & 1]
        smaller = sum(scaled[coalition ^ one] for one in members)
        scaled[coalition] = factorial(len(members) - 1) * int(worth[coalition]) + smaller
    return scaled


def audit_rows(part: str, counts: pd.DataFrame) -> list[tuple]:
    """The rows of SCHEMA of one part from its counts per mask."""
    mask = counts["mask"].to_numpy(np.int64)
    lost, good, toxic = (worths(mask, counts[c].to_numpy(np.int64)) for c in COUNTS)
    n = int(counts["n"].sum())
    scaled, everyone = potentials(lost), (1 << len(FILTERS)) - 1
    # potentials of 5 and of 4 filters are scaled by 5! and 4!
    shapley = [scaled[-1] - len(FILTERS) * scaled[everyone ^ 1 << i] for i in range(len(FILTERS))]
    rows = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            now = before | 1 << i
            removed = int(lost[now] - lost[before])
            row = (part, name, step, n - int(lost[now]), removed, int(lost[1 << i]) - removed)
            row += (int(lost[everyone] - lost[everyone ^ 1 << i]),)
            row += (int(good[now] - good[before]), int(toxic[now] - toxic[before]), shapley[i])
            rows.append(row)
            before = now
    return rows


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """Per part of `docs` (doc_id, text, `part_col`), order of the filters and step: see SCHEMA."""
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def rows(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(audit_rows(key[0], counts), columns=names)

    # at most 32 rows in a part
    return fail_counts(docs, labels, part_col).groupBy("part").applyInPandas(rows, SCHEMA)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op13_filter_audit": op13_filter_audit}
ORACLE = {
    "op13_filter_audit": r"""
        WITH RECURSIVE marks AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS quality,
                   max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels GROUP BY doc_id
        ), d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS words
            FROM documents
        ), least AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
        failed AS (
            SELECT part, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic,
              (len(words) < 100)::INT
              + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
              + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
              + 8 * regexp_matches(t, '[#$%&*|]')::INT
              + 16 * coalesce(first_id < d.doc_id, false)::INT AS mask
            FROM d JOIN least USING (t) LEFT JOIN marks ON marks.doc_id = d.doc_id
        ), counts AS (
            SELECT part, mask, count(*) AS n, sum(quality) AS good, sum(toxic) AS toxic
            FROM failed GROUP BY part, mask
        ), coalitions AS (
            SELECT part, c.s, coalesce(sum(n) FILTER (WHERE mask & c.s <> 0), 0) AS lost,
              coalesce(sum(good) FILTER (WHERE mask & c.s <> 0), 0) AS good,
              coalesce(sum(toxic) FILTER (WHERE mask & c.s <> 0), 0) AS toxic, sum(n) AS n
            FROM counts, (SELECT unnest(range(32)) AS s) c GROUP BY part, c.s
        ), filters AS (
            SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) f(name, bit)
        ), paths AS (
            SELECT '' AS name, 0 AS s
            UNION ALL
            SELECT p.name || f.name, p.s + f.bit FROM paths p, filters f WHERE p.s & f.bit = 0
        ), steps AS (
            SELECT o.name AS filter_order, k.step, f.bit,
              list_sum(list_transform(range(1, k.step + 1),
                lambda j: CAST(1 << (ascii(o.name[j]) - 65) AS INT))) AS upto
            FROM paths o, (SELECT unnest(range(1, 6)) AS step) k
            JOIN filters f ON f.name = o.name[k.step] WHERE length(o.name) = 5
        ), made AS (
            SELECT a.part, filter_order, step, bit, a.n - a.lost AS kept, a.lost - b.lost AS removed,
              i.lost - (a.lost - b.lost) AS redundant, w.lost - x.lost AS unique_fails,
              a.good - b.good AS good_lost, a.toxic - b.toxic AS toxic_lost
            FROM steps JOIN coalitions a ON a.s = upto
            JOIN coalitions b ON b.part = a.part AND b.s = upto - bit
            JOIN coalitions i ON i.part = a.part AND i.s = bit
            JOIN coalitions w ON w.part = a.part AND w.s = 31
            JOIN coalitions x ON x.part = a.part AND x.s = 31 - bit
        )
        SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
          CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
          CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
          CAST(toxic_lost AS BIGINT) AS toxic_lost,
          CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM made
    """
}
