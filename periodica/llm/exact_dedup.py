"""Exact duplicates by a tree merge of sorted digest runs.

Every scan partition makes a run: one entry per digest, sorted. The runs are merged in binomial
rounds over `fan_in ** rounds` nodes. In round r the nodes whose numbers differ in digit r only
exchange runs: an entry goes to the one among them whose digit r equals its digest's. Each node then
merges the runs it received and folds equal entries into one, so a group of copies, however large,
has at most `fan_in` entries per node in a round. After the last round the digits of a node are those
of its digests: each digest lives at one node, and no node ever held more than its share.

An entry is (short digest, SHA-256, length) of the normalised text; the short digest orders and
routes, the SHA-256 and the length verify. Entries that agree in the short digest alone stay apart at
every level. Each keeps the number of its rows and its best row: most code points in the original
text, then the smallest id (a null id comes last).

Defined results: null and empty texts, and texts of white space alone, are equal to each other.
Repeated rows count each. Rows that repeat id, length and normalised text of the best row are all
marked kept, as their ids can't tell them apart; `deduplicated` retains one of them. An empty table
gives an empty table. Other columns are never read by name and survive `deduplicated` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import BLANKS, fan_out, table

ENTRY = ["digest", "sha", "n_norm", "best_len", "best_id", "n_rows"]
SCHEMA = (
    "node int, digest long, sha binary, n_norm int, best_len int, best_id long, n_rows long"
)


def sorted_run(run: DataFrame) -> DataFrame:
    """Each partition in order, the best entry of a text first, then folded."""
    best_first = [F.desc("best_len"), F.asc_nulls_last("best_id")]
    run = run.sortWithinPartitions("digest", "sha", "n_norm", *best_first)
    return run.mapInArrow(fold_sorted, SCHEMA)


def fold_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold neighbours with the same digest, SHA-256 and length; the first is the best of them."""
    last = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]).combine_chunks()
        if last is not None:
            rows = pa.concat_tables([last, rows]).combine_chunks()
        n = rows.num_rows
        if n == 0:
            continue
        differs = np.zeros(n - 1, bool)
        for name in ("digest", "sha", "n_norm"):
            c = rows[name]
            differs |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy()
        starts = np.flatnonzero(np.r_[True, differs])
        counts = np.add.reduceat(rows["n_rows"].to_numpy(), starts)
        folded = rows.take(pa.array(starts))
        at = folded.schema.get_field_index("n_rows")
        folded = folded.set_column(at, folded.schema.field(at), pa.array(counts, pa.int64()))
        last = folded.slice(len(starts) - 1)
        yield from folded.slice(0, len(starts) - 1).to_batches()
    if last is not None:
        yield from last.to_batches()


def with_digest(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with sha, n_norm and n_orig of its texts; the normal form itself is not kept."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    norm = F.translate(text, BLANKS, "")
    return docs.select(
        "*",
        F.unhex(F.sha2(norm.cast("binary"), 256)).alias("sha"),
        F.char_length(norm).alias("n_norm"),
        F.char_length(text).alias("n_orig"),
    )


def tree_merge(entries: DataFrame, fan_in: int = 8, nodes_wanted: int | None = None) -> DataFrame:
    """Merge sorted runs of entries (columns of ENTRY) in binomial rounds; one entry per text."""
    rounds = 1
    while fan_in**rounds < (nodes_wanted or fan_out(entries.sparkSession)):
        rounds += 1
    nodes = fan_in**rounds
    run = entries.select((F.spark_partition_id() % nodes).alias("node"), *ENTRY)
    run = sorted_run(run)
    for r in range(rounds):
        step = fan_in**r
        own = F.pmod(F.floor(F.col("node") / step), F.lit(fan_in))
        theirs = F.pmod(F.shiftright("digest", 8 + 4 * r), F.lit(fan_in))
        node = (F.col("node") + (theirs - own) * step).cast("int")
        run = sorted_run(run.withColumn("node", node).repartitionById(nodes, F.col("node")))
    return run.drop("node")


def copy_groups(docs: DataFrame, fan_in: int = 8) -> DataFrame:
    """One row per different text of `docs` (doc_id, sha, n_norm, n_orig)."""
    entries = docs.select(
        F.xxhash64("sha").alias("digest"),
        "sha",
        "n_norm",
        F.col("n_orig").alias("best_len"),
        F.col("doc_id").alias("best_id"),
        F.lit(1).cast("long").alias("n_rows"),
    )
    return tree_merge(entries, fan_in)


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8
) -> DataFrame:
    """Per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    rows = with_digest(rows).drop("text")
    groups = copy_groups(rows, fan_in).select(
        F.col("sha").alias("group_sha"),
        F.col("n_norm").alias("group_norm"),
        "best_len",
        F.col("best_id").alias("keep_id"),
        F.col("n_rows").alias("group_size"),
    )
    same = (F.col("sha") == F.col("group_sha")) & (F.col("n_norm") == F.col("group_norm"))
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_orig") == F.col("best_len"))
    return rows.join(groups, same).select(
        "doc_id", "keep_id", "group_size", best.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8
) -> DataFrame:
    """`docs` with all its columns, one row of each group of equal texts."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    groups = copy_groups(with_digest(rows).drop("text"), fan_in)
    best = groups.select("best_id", "best_len", "sha")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = docs.select(
        F.struct("*").alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("own_id"),
        F.char_length(text).alias("own_len"),
        F.unhex(F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256)).alias("own_sha"),
    )
    same_id = F.col("own_id").eqNullSafe(F.col("best_id"))
    match = same_id & (F.col("own_len") == F.col("best_len")) & (F.col("own_sha") == F.col("sha"))
    # the key has the id, so a large group of copies spreads over all tasks
    one = own.join(best, match).dropDuplicates(["own_id", "own_len", "own_sha"])
    return one.select("row.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op8_exact_dedup": op8_exact_dedup}
ORACLE = {
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents
        ), g AS (
            SELECT norm, count(*) AS group_size,
                   arg_max(doc_id, length(t)::HUGEINT * 10000000000000000000 - doc_id) AS keep_id
            FROM d GROUP BY norm
        )
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
               sha256(d.norm) AS text_sha256
        FROM d JOIN g USING (norm)
    """
}
