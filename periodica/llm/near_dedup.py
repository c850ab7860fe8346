"""Near-duplicate texts by SetSketch registers, exactly verified.

1. One pass over the texts gives each its shingle set's size, a 128-bit key and a SetSketch. Equal
   sets are one node, whatever the number of their rows; its id is their least document id.
2. Bands of register values are bucketed. Each bucket has a pivot, chosen by hash, and every member
   is paired with it: as many pairs as members. The joint likelihood of the two sketches drops pairs
   that can't reach the threshold; the full sets of the others are compared. Links give labels.
3. Only buckets whose members still differ in label can hide another link. Their members with the
   commonest label are dealt into blocks, each of which meets the blocks of the others; those meet
   among themselves. A tile has two blocks of about `TILE` members with their full sets. Pairs of
   unlike labels that pass the likelihood, in the first band they share, are compared in full right
   there, unless links found in the tile have joined their labels already; so a tile returns fewer
   links than it has labels, however many of its members are alike.
4. Components of all links; the least id stays.

A pair at the threshold shares no band with a probability of 1.3e-7 (40 bands of 5 registers); more
similar ones with less. Nothing else is missed: no bucket, member or candidate is capped.

Defined results: null and empty texts, and texts without words, have an empty set and are linked with
nothing. Rows without id join the component of an equal set that has an id, else they have none and
are kept. Rows that share an id are one document with the links of all its texts. Repeated rows each
have their result. Empty tables give empty tables; other columns are never read by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm import setsketch as S
from periodica.llm.common import fan_out, free_name, sliced, stored, table, texts
from periodica.llm.components import components

TILE = 512
SHINGLE = 5
SKETCH = "doc_id long, n_shingles long, set_key binary, sketch binary"


def sketch_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """The columns of SKETCH per row of `docs` (doc_id, text); no sketch for an empty set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for batch in batches for x in sliced(batch)):
            size, key, sketch = [], [], []
            for text in part.column("text").to_pylist():
                hashes = S.shingle_hashes(text, shingle)
                size.append(len(hashes))
                key.append(S.set_key(hashes))
                sketch.append(S.registers(hashes).tobytes() if len(hashes) else None)
            columns = {"doc_id": part.column("doc_id"), "n_shingles": pa.array(size, pa.int64())}
            columns |= {"set_key": pa.array(key, pa.binary()), "sketch": pa.array(sketch, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(rows, SKETCH)


def sketches(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), S.M)


def band_rows(nodes: DataFrame) -> DataFrame:
    """(key, node): one row per band of each node."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                keys = S.band_keys(sketches(batch["sketch"]))
                yield pd.DataFrame({"key": keys.ravel(), "node": np.repeat(batch["node"], S.BANDS)})

    return nodes.select("node", "sketch").mapInPandas(rows, "key long, node long")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(key, node, pivot, size) of the buckets with two members or more."""
    bands = band_rows(nodes)
    by_hash = F.xxhash64("node", "key")
    buckets = bands.groupBy("key").agg(
        F.count("*").alias("size"), F.min_by("node", by_hash).alias("pivot")
    )
    return bands.join(buckets.filter(F.col("size") > 1), "key")


def likely_pairs(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """`pairs` (a, b) whose sketches don't rule out a resemblance of `least`."""
    for side in ("a", "b"):
        own = nodes.select(
            F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}")
        )
        pairs = pairs.join(own, side)
    alike = F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            a, b = sketches(batch["s_a"]), sketches(batch["s_b"])
            above, below = (a > b).sum(1), (a < b).sum(1)
            estimate, ok = S.plausible(above, below, batch["n_a"], batch["n_b"], least)
            yield batch[["a", "b"]].assign(estimate=estimate)[ok]

    return pairs.filter(alike).mapInPandas(rows, "a long, b long, estimate double")


def shingle_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, hashes) for the nodes in `wanted` (node, set_key), cut from their texts again."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for batch in batches for x in sliced(batch)):
            found = [S.shingle_hashes(t, shingle) for t in part.column("text").to_pylist()]
            keys = part.column("set_key").to_pylist()
            own = [S.set_key(x) == k for x, k in zip(found, keys, strict=True)]
            hashes = pa.array([x.tobytes() for x in found], pa.binary())
            out = pa.RecordBatch.from_pydict({"node": part.column("node"), "hashes": hashes})
            yield out.filter(pa.array(own, pa.bool_()))

    joined = docs.join(wanted, F.col("doc_id") == F.col("node"))
    return joined.select("node", "set_key", "text").mapInArrow(rows, "node long, hashes binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`pairs` (a, b) with 100 * intersection >= percent * union of their full sets."""
    for side in ("a", "b"):
        own = sets.select(F.col("node").alias(side), F.col("hashes").alias(f"h_{side}"))
        pairs = pairs.join(own, side)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for batch in batches for x in sliced(batch)):
            both = (part.column(h).to_pylist() for h in ("h_a", "h_b"))
            sets = ([np.frombuffer(x, np.uint64) for x in side] for side in both)
            ok = [resembles(a, b, percent) for a, b in zip(*sets, strict=True)]
            yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "h_a", "h_b").mapInArrow(rows, "a long, b long").distinct()


def tiles(members: DataFrame, labels: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of buckets with several labels, dealt into tiles of two blocks, with sketch and set."""
    labelled = members.filter(F.col("size") > 2).select("key", "node").join(labels, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    counts = labelled.groupBy("key", "label").agg(F.count("*").alias("n_label")).groupBy("key")
    counts = counts.agg(
        F.max_by("label", F.struct("n_label", "label")).alias("common"),
        F.max("n_label").alias("n_common"),
        F.sum("n_label").alias("n_all"),
    )
    mixed = counts.filter(F.col("n_common") < F.col("n_all")).select(
        "key",
        "common",
        F.ceil(F.col("n_common") / TILE).alias("blocks"),
        F.ceil((F.col("n_all") - F.col("n_common")) / TILE).alias("others"),
    )

    def tile(kind: int, i: Column, j: Column, side: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side")
        )

    def numbers(n: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), n - 1)

    own = F.when(F.col("label") == F.col("common"), F.col("blocks")).otherwise(F.col("others"))
    block = F.pmod(F.xxhash64("node"), own).alias("block")
    rows = labelled.join(mixed, "key").select("*", block)
    mine, zero, one = F.col("block"), F.lit(0), F.lit(1)
    common = F.transform(numbers(F.col("others")), lambda j: tile(0, mine, j, zero))
    across = F.transform(numbers(F.col("blocks")), lambda i: tile(0, i, mine, one))
    among = F.transform(
        numbers(F.col("others")),
        lambda j: tile(1, F.least(mine, j), F.greatest(mine, j), mine > j),
    )
    places = F.when(F.col("label") == F.col("common"), common).otherwise(F.concat(across, among))
    rows = rows.select("key", "node", "label", F.explode(places).alias("tile"))
    rows = rows.select("key", "node", "label", "tile.*")
    return rows.join(nodes.select("node", "n", "sketch"), "node").join(sets, "node")


def resembles(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def links_in_tile(key: int, same: bool, tile: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links between unlike labels in one tile, as many as it takes to join what is linked."""
    band, least = key & 63, percent / 100
    a = tile[tile["side"] == 0]
    b = a if same else tile[tile["side"] == 1]
    if not len(a) or not len(b):
        return []
    s_b, n_b, node_b = sketches(b["sketch"]), b["n"].to_numpy(), b["node"].to_numpy()
    sets_b = [np.frombuffer(x, np.uint64) for x in b["hashes"]]
    # labels as small numbers, the least of what is joined so far
    names = np.unique(np.concatenate((a["label"].to_numpy(), b["label"].to_numpy())))
    class_a, class_b = (np.searchsorted(names, x["label"].to_numpy()) for x in (a, b))
    links = []
    for k, row in enumerate(a.itertuples(index=False)):
        own = np.frombuffer(row.sketch, np.uint16)
        ratio = np.minimum(row.n, n_b) >= least * np.maximum(row.n, n_b)
        at = np.flatnonzero((class_b != class_a[k]) & ratio)
        if same:
            at = at[at > k]
        if not len(at):
            continue
        equal = s_b[at] == own
        # far below what the likelihood could accept
        near = equal.sum(1) >= (least - 0.2) * S.M
        at, equal = at[near], equal[near]
        at = at[equal.reshape(len(at), S.BANDS, S.ROWS).all(2).argmax(1) == band]
        if not len(at):
            continue
        above, below = (own > s_b[at]).sum(1), (own < s_b[at]).sum(1)
        estimate, ok = S.plausible(above, below, np.full(len(at), row.n), n_b[at], least)
        mine = np.frombuffer(row.hashes, np.uint64)
        # the likeliest first: a link found early spares the rest of its label
        for j in at[ok][np.argsort(-estimate[ok])]:
            if class_b[j] != class_a[k] and resembles(mine, sets_b[j], percent):
                links.append((row.node, int(node_b[j])))
                low, high = sorted((class_a[k], class_b[j]))
                class_a[class_a == high] = low
                class_b[class_b == high] = low
    return links


def unlike_links(tiled: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between labels, found tile by tile."""
    place = ["key", "kind", "i", "j"]
    dealt = tiled.repartition(fan_out(tiled.sparkSession), *place).sortWithinPartitions(*place)

    def found(where: tuple, parts: list[pd.DataFrame]) -> pd.DataFrame:
        same = where[1] == 1 and where[2] == where[3]
        links = links_in_tile(where[0], same, pd.concat(parts), percent)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # tiles arrive in order; the last of a batch may go on in the next one
        held: list[pd.DataFrame] = []
        at = None
        for batch in batches:
            for where, part in batch.groupby(place, sort=True):
                if where != at:
                    if held:
                        yield found(at, held)
                    held, at = [], where
                held.append(part)
        if held:
            yield found(at, held)

    return dealt.mapInPandas(rows, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = 80) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    docs = texts(docs)
    least = percent / 100
    rows = stored(sketch_rows(docs, shingle))
    full = rows.filter(F.col("n_shingles") > 0)
    nodes = full.groupBy("set_key").agg(
        F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    nodes = stored(nodes.filter(F.col("node").isNotNull()))
    members = stored(bucket_members(nodes))

    pairs = members.filter(F.col("node") != F.col("pivot")).select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")
    )
    likely = likely_pairs(pairs.distinct(), nodes, least)
    wanted = members.select("node").distinct().join(nodes.select("node", "set_key"), "node")
    sets = stored(shingle_sets(docs, wanted, shingle))
    labels = components(verified(likely, sets, percent))

    more = unlike_links(tiles(members, labels, nodes, sets), percent)
    # what is left links whole components
    for side in ("a", "b"):
        own = labels.select(F.col("node").alias(side), F.col("label").alias(f"l_{side}"))
        more = more.join(own, side, "left")
    more = more.select(F.coalesce("l_a", "a").alias("a"), F.coalesce("l_b", "b").alias("b"))
    joined = components(more).select(F.col("node").alias("at"), F.col("label").alias("least"))
    known = nodes.select("set_key", "node").join(labels, "node", "left")
    known = known.withColumn("label", F.coalesce("label", "node"))
    known = known.join(joined, F.col("label") == F.col("at"), "left")
    known = known.select(F.col("set_key").alias("own_key"), F.coalesce("least", "label").alias("class"))
    found = rows.select("doc_id", "n_shingles", "set_key").join(
        known, (F.col("set_key") == F.col("own_key")) & (F.col("n_shingles") > 0), "left"
    )
    component = F.coalesce("class", "doc_id").alias("component_id")
    kept = F.col("component_id").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component).withColumn("kept", kept)


def representatives(docs: DataFrame, shingle: int = SHINGLE, percent: int = 80) -> DataFrame:
    """`docs`, all columns, without the near copies of a smaller id."""
    gone = near_duplicates(docs, shingle, percent).filter(~F.col("kept") & F.col("doc_id").isNotNull())
    name = free_name(docs.columns, "gone_id")
    gone = gone.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


QUERIES = {"op2_near_dedup": op2_near_dedup}
ORACLE = {
    "op2_near_dedup": r"""
        WITH RECURSIVE cut AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda w: w <> '') AS words
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 2),
                    lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
            FROM cut
        ), each AS (
            SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id
            HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
        ), reach AS (
            SELECT a, b FROM links
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT doc_id, len(shingles) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
               doc_id <= coalesce(b, doc_id) AS kept
        FROM sets LEFT JOIN least ON a = doc_id
    """
}
