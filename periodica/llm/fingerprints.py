"""Document fingerprints: bottom-k sketches of word shingles, built of DataFrame functions only.

The fingerprint of a text is the `k` least different hashes of its 5-word shingles (lower-case A-Z,
words between white space; a shorter text is one shingle, a text without words has none). Sketches of
parts merge into the sketch of the whole, and estimate

- resemblance: the share of the union's k least hashes that both have,
- containment of one in the other,
- the number of different shingles.

All are exact while the sets have at most k shingles.

`with_next` gives every row the next one in descending order of id without a sort in one place: ids
are dealt to ranges by approximate quantiles, each range is one partition, and the first row of a
range is also sent, marked, to the range before it (that of the first range to the last one).

Defined results: a null text is empty; two texts without shingles resemble each other fully, one
without never resembles one with. Null ids come last; rows with equal ids follow each other by text.
The only row of a table is its own next one. Empty tables give empty tables. Rows of one id share a
range. Other columns than id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm.common import BLANKS, fan_out, table, texts

K = 128
SHINGLE = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_hashes(text: Column) -> Column:
    """A hash per word; an empty array for a text without words."""
    plain = F.btrim(F.translate(text, UPPER, LOWER), F.lit(BLANKS))
    words = F.split(plain, r"[\x20\x09-\x0D]+")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(plain == "", F.array().cast("array<bigint>")).otherwise(hashes)


def sketch_of(hashes: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The k least different shingle hashes, ascending, from the hashes of the words in order."""
    n = F.size(hashes)
    wanted = F.greatest(n - (shingle - 1), F.least(n, F.lit(1)))
    every = F.transform(hashes, lambda _, i: F.xxhash64(F.slice(hashes, i + 1, shingle)))
    return F.slice(F.sort_array(F.array_distinct(F.slice(every, F.lit(1), wanted))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_count(a: Column, k: int = K) -> Column:
    """Number of different shingles: exact below k, else from where the k-th hash lies."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of intersection over union."""
    both = F.size(F.array_intersect(merged(a, b, k), F.array_intersect(a, b)))
    nothing = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(nothing, F.lit(1.0)).otherwise(both / F.size(merged(a, b, k)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of the share of a's shingles that b has; 1 where a has none."""
    shared = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    share = F.least(F.lit(1.0), shared / distinct_count(a, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(share)


def as_text(a: Column) -> Column:
    return F.concat_ws(",", F.transform(a, lambda x: F.lower(F.hex(x))))


def merge_parts(parts: DataFrame, key: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """(key, sketch) of groups of any number of parts; at most k hashes of a group meet."""
    hashes = parts.select(F.col(f"`{key}`").alias("key"), F.explode(f"`{sketch}`").alias("hash"))
    least = Window.partitionBy("key").orderBy("hash")
    ranked = hashes.distinct().withColumn("nth", F.row_number().over(least))
    found = ranked.filter(F.col("nth") <= k).groupBy("key")
    whole = found.agg(F.sort_array(F.collect_list("hash")).alias("found"))
    # groups of empty sketches only
    keys = parts.select(F.col(f"`{key}`").alias("key")).distinct()
    own = keys.join(whole.withColumnRenamed("key", "own"), F.col("key").eqNullSafe(F.col("own")), "left")
    none = F.array().cast("array<bigint>")
    return own.select(F.col("key").alias(key), F.coalesce("found", none).alias(sketch))


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the descending `bounds` exceed `key`, found in two short steps."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    every = F.array(*[F.lit(x).cast("long") for x in bounds])
    coarse = F.array(*[F.lit(x).cast("long") for x in bounds[::step]])
    block = F.size(F.filter(coarse, lambda x: x > key))
    first = (block - 1) * step
    within = F.size(F.filter(F.slice(every, first + 1, step), lambda x: x > key))
    return F.when(block == 0, F.lit(0)).otherwise(first + within)


def in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """`docs` (doc_id, text) one range of descending ids per partition, with marked next rows."""
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    ids = docs.select(key.alias("key"))
    steps = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = ids.agg(F.percentile_approx("key", steps, 20 * ranges)).first()[0] or []
    bounds = sorted(set(cuts), reverse=True) if ranges > 1 else []
    rows = docs.select("*", key.alias("key"), range_of(key, bounds).cast("int").alias("part"))
    # one row per range, as many as partitions
    tops = ids.select("key", range_of(F.col("key"), bounds).cast("int").alias("part"))
    tops = tops.groupBy("part").agg(F.max("key").alias("top"))
    before = F.lag("part").over(Window.orderBy("part"))
    last = F.max("part").over(Window.partitionBy())
    also = tops.select("top", F.coalesce(before, last).alias("also"))
    rows = rows.join(F.broadcast(also), F.col("key") == F.col("top"), "left")
    places = F.array(
        F.struct(F.col("part"), F.lit(False).alias("marked")),
        F.struct(F.col("also").alias("part"), F.lit(True).alias("marked")),
    )
    places = F.filter(places, lambda x: x["part"].isNotNull())
    rows = rows.select("doc_id", "text", "key", F.explode(places).alias("place"))
    rows = rows.select("doc_id", "text", "key", "place.*")
    return rows.repartitionById(len(bounds) + 1, F.col("part"))


def with_next(docs: DataFrame, ranges: int, k: int = K) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch) per row of `docs` (doc_id, text)."""
    rows = in_ranges(docs, ranges).withColumn("hashes", word_hashes(F.col("text")))
    rows = rows.withColumn("sketch", sketch_of(F.col("hashes"), k)).drop("hashes")
    order = Window.partitionBy("part").orderBy("marked", F.desc("key"), "text")
    rows = rows.withColumn("next_text", F.lead("text").over(order))
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(order))
    return rows.filter(~F.col("marked")).drop("part", "key", "marked")


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the code points gives way to as many first ones of the following text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, sketch and the estimated number of shingles."""
    rows = texts(docs).withColumn("hashes", word_hashes(F.col("text")))
    rows = rows.select("doc_id", sketch_of(F.col("hashes"), k, shingle).alias("sketch"))
    return rows.withColumn("n_shingles", distinct_count(F.col("sketch"), k))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    rows = with_next(docs, fan_out(spark))
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text"))).drop("next_text")
    rows = rows.withColumn("hashes", word_hashes(F.col("edited")))
    rows = rows.withColumn("edited_sketch", sketch_of(F.col("hashes"))).drop("hashes")
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"),
        as_text(edited).alias("edited_fingerprint"),
        resemblance(own, edited).alias("near_edited"),
        resemblance(own, following).alias("near_next"),
        containment(edited, own).alias("edited_in_own"),
        distinct_count(own).alias("n_shingles"),
    )


QUERIES = {"op5_fingerprints": op5_fingerprints}
ORACLE: dict[str, str] = {}
