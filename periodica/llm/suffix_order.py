"""Order of all suffixes of many strings by the difference-cover method, as Spark joins and sorts.

A string is the rows (text, at, sym) of one text with consecutive `at`; where a number is missing it
ends. Positions with at mod 3 in {1, 2} are the sample: any two positions have, at most two steps
further on, a pair of sampled ones.

1. The symbols of a sampled position and the next two form a triple; the different triples are sorted
   and numbered, and each sampled position gets its triple's number as name.
2. If equal names leave an order open, the names of each class form new strings, which are ordered
   the same way; only open names and what follows them are needed there. Names are final for the
   purpose here once they cover `depth` units of text.
3. The other positions are ordered by (symbol, rank of the next position), and merged with the
   sample: against class 1 by that pair, against class 2 by two symbols and the rank after them. The
   merge counts, for every key, what lies below it.

Sorts are range partitions of different keys with their counts, so a key that holds most of the rows
is one row; running totals pass from range to range through one row per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from periodica.llm.common import settled, stored

#: Above any position; keeps the strings of the two sample classes of a text apart.
APART = 1 << 40


def numbered(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """`rows`, which differ in `keys`, with each column of `sums` replaced by its total over all smaller keys."""
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    added = [StructField("part", LongType()), *(StructField(f"{n}_own", LongType()) for n in sums)]
    schema = StructType([*rows.schema.fields, *added])

    def totals_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, upto = TaskContext.get().partitionId(), dict.fromkeys(sums, 0)
        for batch in batches:
            own = [pa.array(np.full(len(batch), part))]
            for n in sums:
                values = batch.column(n).to_numpy()
                total = np.cumsum(values) + upto[n]
                own.append(pa.array(total - values))
                upto[n] = int(total[-1]) if len(total) else upto[n]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], schema.names)

    ranged = stored(ranged.mapInArrow(totals_within, schema))
    # one row per range
    totals = ranged.groupBy("part").agg(*[F.sum(n).alias(f"{n}_all") for n in sums])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "part", *[F.coalesce(F.sum(f"{n}_all").over(before), F.lit(0)).alias(f"{n}_before") for n in sums]
    )
    joined = ranged.join(F.broadcast(totals), "part")
    kept = [F.col(c) for c in rows.columns if c not in sums]
    return joined.select(*kept, *[(F.col(f"{n}_own") + F.col(f"{n}_before")).alias(n) for n in sums])


def running(rows: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """One row per different key: per name in `sums`, the total over all smaller keys."""
    counted = rows.groupBy(*keys).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    return numbered(counted, keys, list(sums))


def matched(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with the columns of `known`, joined on keys that may be null."""
    renamed = known.select(
        *[F.col(k).alias(f"{k}_known") for k in keys], *[c for c in known.columns if c not in keys]
    )
    same = [F.col(k).eqNullSafe(F.col(f"{k}_known")) for k in keys]
    # different keys: an even share of them in each task, so the rows need no sort
    return rows.join(renamed.hint("shuffle_hash"), same).drop(*[f"{k}_known" for k in keys])


def following(rows: DataFrame, column: str, steps: int) -> Column:
    """The value `steps` positions on in the same string; null behind its end."""
    order = Window.partitionBy("text").orderBy("at")
    near = F.lead("at", steps).over(order) == F.col("at") + steps
    return F.when(near, F.lead(column, steps).over(order))


def suffix_ranks(strings: DataFrame, depth: int, levels: int = 64) -> DataFrame:
    """(text, at, rank) for `strings` (text, at, sym, size): how many suffixes are smaller. Suffixes
    may share a rank if they are equal, agree in `depth` units of size, or in 3 ** (levels + 1)
    symbols."""
    return settled(lambda: _suffix_ranks(stored(triples(strings)), depth, levels))


def ranks_of(rows: DataFrame, depth: int, levels: int = 64) -> DataFrame:
    """`suffix_ranks` of stored `rows` that have the columns of `triples`."""
    return settled(lambda: _suffix_ranks(rows, depth, levels))


def triples(strings: DataFrame) -> DataFrame:
    """(text, at, sym, sym1, sym2, kind, covers): the symbols of each position and the next two, null
    behind the string's end, the position's class, and the size of all three."""
    rows = strings.select(
        "text", "at", "sym", "size",
        following(strings, "sym", 1).alias("sym1"), following(strings, "sym", 2).alias("sym2"),
        following(strings, "size", 1).alias("size1"), following(strings, "size", 2).alias("size2"),
    )
    zero = F.lit(0).cast("long")
    return rows.select(
        "text", "at", "sym", "sym1", "sym2", kind(),
        (F.col("size") + F.coalesce("size1", zero) + F.coalesce("size2", zero)).alias("covers"),
    )


def kind() -> Column:
    return F.pmod("at", F.lit(3)).alias("kind")


def _suffix_ranks(rows: DataFrame, depth: int, levels: int) -> DataFrame:
    triple = ["sym", "sym1", "sym2"]
    sample = rows.filter("kind > 0")
    different = sample.select(*triple).distinct()
    names = running(different, triple, {"name": F.lit(1).cast("long")})
    named = stored(
        matched(sample, names, triple).select("text", "at", "kind", *triple, "covers", "name")
    )

    # equal names that go on in the text and cover too little leave the order open
    goes_on = F.col("sym2").isNotNull() & (F.col("covers") < depth)
    open_names = named.groupBy("name").agg(F.count("*").alias("n"), F.max(goes_on).alias("goes_on"))
    open_names = open_names.filter("n > 1 and goes_on").select("name")
    if levels == 0 or open_names.isEmpty():
        return merged_ranks(rows, named.withColumnRenamed("name", "rank"))
    place = F.floor(F.col("at") / 3) + (F.col("kind") - 1) * APART
    marked = named.join(open_names.withColumn("open", F.lit(True)).hint("shuffle_hash"), "name", "left")
    shorter = marked.select(
        "text", "kind", F.col("at").alias("place"), place.cast("long").alias("at"),
        F.col("name").alias("sym"), F.col("covers").alias("size"), "open",
        F.col("sym").alias("own_sym"), F.col("sym1").alias("own_sym1"),
    )
    # what follows an open name decides; behind a name that is settled nothing matters
    order = Window.partitionBy("text").orderBy("at")
    after = (F.lag("at").over(order) == F.col("at") - 1) & F.lag("open").over(order)
    shorter = stored(shorter.withColumn("needed", F.coalesce(F.col("open"), after, F.lit(False))))
    inner = suffix_ranks(shorter.filter("needed").select("text", "at", "sym", "size"), depth, levels - 1)
    inner = inner.withColumnRenamed("rank", "inner").hint("shuffle_hash")
    joined = shorter.join(inner, ["text", "at"], "left").select(
        "text", F.col("place").alias("at"), "kind", F.col("own_sym").alias("sym"), F.col("own_sym1").alias("sym1"),
        F.col("sym").alias("name"), F.when(F.col("open"), F.col("inner")).alias("inner"),
    )
    joined = stored(joined)
    numbers = running(joined, ["name", "inner"], {"rank": F.lit(1).cast("long")})
    ranks = matched(joined, numbers, ["name", "inner"])
    ranks = ranks.select("text", "at", "kind", "sym", "sym1", "rank")
    return merged_ranks(rows, stored(ranks))


def merged_ranks(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """Ranks of all positions of `rows`, given those of the sample, beside what `rows` has of it."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    columns = ["text", "at", "kind", "sym", "sym1"]
    rest = rows.filter("kind = 0").select(*columns, F.lit(None).cast("long").alias("rank"))
    own = rest.unionByName(ranks.select(*columns, "rank"))
    own = stored(
        own.select(
            "text", "at", "kind", "sym", "sym1", F.col("rank").alias("own"),
            following(own, "rank", 1).alias("rank1"), following(own, "rank", 2).alias("rank2"),
        )
    )
    rest = F.when(F.col("kind") == 0, one).otherwise(none)
    other = F.when(F.col("kind") != 0, one).otherwise(none)
    first = own.filter("kind <> 2")
    below1 = running(first, ["sym", "rank1"], {"rest1": rest, "other1": other})
    second = own.filter("kind <> 1")
    below2 = running(second, ["sym", "sym1", "rank2"], {"rest2": rest, "other2": other})
    below = running(ranks, ["rank"], {"sample": one})

    keys1, keys2 = ["sym", "rank1"], ["sym", "sym1", "rank2"]
    plain = matched(matched(own.filter("kind = 0"), below1, keys1), below2, keys2)
    plain = plain.select("text", "at", (F.col("rest1") + F.col("other1") + F.col("other2")).alias("rank"))
    sampled = own.withColumn("rank", F.col("own"))
    of1 = matched(matched(sampled.filter("kind = 1"), below1, keys1), below, ["rank"])
    of1 = of1.select("text", "at", (F.col("sample") + F.col("rest1")).alias("rank"))
    of2 = matched(matched(sampled.filter("kind = 2"), below2, keys2), below, ["rank"])
    of2 = of2.select("text", "at", (F.col("sample") + F.col("rest2")).alias("rank"))
    return plain.unionByName(of1).unionByName(of2)
