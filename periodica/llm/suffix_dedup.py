"""Passages of 400 bytes and more that occur again anywhere, found by a distributed suffix order.

1. Texts are cut into phrases at content-defined boundaries, so that equal passages have equal
   phrases. A phrase that occurs once ends any repeat; what is left are runs of repeated phrases,
   strings of phrase names some sixty times shorter than the text.
2. `suffix_order` sorts the suffixes of these strings by the difference-cover method: triples of
   sampled places, recursion on their names, merge of the rest. Neighbours in that order are
   compared: how many bytes of phrases they share tells how far a place's best partner reaches. Where
   it is 400 bytes, the place starts a repeat, and what lies between neighbouring such places of a
   text is covered by repeats. (Where a text repeats itself phrase by phrase, as in "ha ha ha", 400
   bytes from either end of the stretch are enough for the order.)
3. A repeat may begin up to 127 bytes before a boundary, and end between two. Where a phrase isn't
   well inside such a cover and its partner reaches far enough, the 400 bytes from every start before
   it are compared exactly, by two 64-bit hashes: first in blocks of 32 starts, which all repeat if
   the block's bytes do, then one by one where only what they share does. For places well inside, one
   of each different surrounding is compared along, so that the others find their partner.
4. Per text, the bytes of all repeats are removed and the others joined.

Texts equal to another one are one string; if it has 400 bytes, nothing of them is kept.

Defined results: a null text counts as empty; a text below 400 bytes keeps all. A passage repeated
within one text counts, its occurrences may overlap. Rows with equal id and text have equal results,
as copies of each other. Null ids and ties need no rule; empty tables give empty tables; other
columns are not read. Texts are told apart by a 64-bit hash of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm import phrases as P
from periodica.llm.common import fan_out, settled, sliced, stored, table, texts
from periodica.llm.suffix_order import kind, numbered, ranks_of

#: A repeat shares at least the first of these with its partner behind its first common boundary, and
#: one that starts 127 - x bytes nearer to it x bytes more.
REACHES = (P.LENGTH - P.BEFORE - P.BEHIND, 162, 194, 226, P.LENGTH - P.BEHIND, P.LENGTH)
#: Names of this level cover nine phrases, mostly more than 400 bytes.
LEVELS = 1
NAMED = 3 ** (LEVELS + 1)
BLOCK = 32
#: Bound of the names that are sent to all tasks.
FEW = 1000
BLOCKS = ("text", "high", "low", "last", "core", "hull1", "hull2")
RUNS = (
    "text long, at long, pos int, size int, name long, "
    + ", ".join(f"key{c} long" for c in REACHES)
    + ", second long, around long, given boolean, base boolean, ordered boolean, low long, high long"
    + ", sym1 long, sym2 long, covers long, short boolean"
)
RESULT = "text long, n_removed long, n_spans long, kept_sha256 string"


def text_key() -> Column:
    return F.xxhash64("doc_id", "text")


def phrase_rows(docs: DataFrame) -> DataFrame:
    """(text, place, name) of every phrase of `docs` (doc_id, text); a place is its first byte's
    number times 256 plus its length."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for batch in batches for x in sliced(batch)):
            found = [P.phrases(t) for t in part.column("content").to_pylist()]
            pos, size, name = (np.concatenate(x) for x in zip(*found, strict=True))
            text = np.repeat(part.column("text").to_numpy(), [len(x[0]) for x in found])
            yield pa.RecordBatch.from_pydict({"text": text, "place": pos << 8 | size, "name": name})

    long_enough = F.octet_length("text") >= P.LENGTH
    content = F.col("text").cast("binary").alias("content")
    keyed = docs.filter(long_enough).select(text_key().alias("text"), content)
    return keyed.mapInArrow(rows, "text long, place long, name long")


def repeated(rows: DataFrame) -> DataFrame:
    """The phrases of the stored `rows` whose name occurs at two places or more.

    The names that hold more than one in `FEW` of the rows each, fewer than `FEW` of them, are sent
    to all tasks, so that their rows need not meet anywhere.
    """
    often = stored(rows.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1"))
    most = F.broadcast(often.filter(F.col("n") > rows.count() // FEW).select("name"))
    others = rows.join(most, "name", "left_anti")
    # different names: an even share of them in each task, so the phrases need no sort
    others = others.join(often.select("name").hint("shuffle_hash"), "name")
    return others.unionByName(rows.join(most, "name", "left_semi"))


def by_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by text, dealt anew so that none ends within a text."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch["text"].to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut or (held and held[-1]["text"].iloc[-1] != key[-1]):
            yield pd.concat([*held, batch[:cut]])
            held = []
        held.append(batch[cut:])
    if held:
        yield pd.concat(held)


def column(values: np.ndarray, known: np.ndarray, like: pd.DataFrame) -> pd.Series:
    # masked, as 64 bits don't pass through floating point
    return pd.Series(pd.arrays.IntegerArray(values.astype(np.int64, copy=False), ~known), index=like.index)


def ahead(values: np.ndarray, steps: int) -> np.ndarray:
    """The value so many places on; zero behind the last."""
    return np.concatenate((values[steps:], np.zeros(min(steps, len(values)), values.dtype)))


def runs_of(rows: DataFrame) -> DataFrame:
    """The columns of RUNS per repeated phrase: keys of the phrases that cover so many bytes from
    there (null where the run is shorter), of its surroundings, the run's zone, whether the text
    itself repeats there, one phrase on or back (`given`), whether it doesn't merely repeat the next
    place (`base`), whether the order needs it, `triples` for the order, and whether the phrases that the order tells apart are `short` of 400 bytes."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_text(batches):
            text, place = batch["text"].to_numpy(), batch["place"].to_numpy(np.int64)
            pos, size = place >> 8, place & 255
            opens = np.concatenate(([True], (text[1:] != text[:-1]) | (pos[1:] != (pos + size)[:-1])))
            run = np.cumsum(opens)
            covers = P.Covers(batch["name"].to_numpy(), size, run)
            out = {f"key{c}": column(*covers.key(c), batch) for c in REACHES}
            out["second"] = column(*covers.key(P.LENGTH, which=1), batch)
            out["around"] = column(*covers.key(P.LENGTH, before=P.BEFORE), batch)
            key, whole = covers.key(P.LENGTH)
            same = np.concatenate((whole[:-1] & whole[1:] & ~opens[1:] & (key[1:] == key[:-1]), [False]))
            # a place is in order unless it only repeats the next one, 400 bytes behind the last
            # that doesn't and behind the start of its run
            base = np.maximum.accumulate(np.where(same & ~opens, 0, covers.begin))
            first = np.flatnonzero(opens)
            last = np.append(first[1:], len(run)) - 1
            ordered = ~same | (covers.begin - base < P.LENGTH)
            # the next two phrases, as far as the run goes and the order needs them
            name, sizes = batch["name"].to_numpy(), [size]
            goes_on, symbols = ordered, {}
            for steps in (1, 2):
                goes_on = goes_on & ahead(ordered, steps) & (ahead(run, steps) == run)
                symbols[f"sym{steps}"] = column(ahead(name, steps), goes_on, batch)
                sizes.append(np.where(goes_on, ahead(size, steps), 0))
            yield batch[["text", "name"]].assign(
                # one number is left out between runs
                at=np.arange(len(run)) + run,
                pos=pos,
                size=size,
                **out,
                given=same | np.concatenate(([False], same[:-1])),
                base=~same,
                ordered=ordered,
                low=np.maximum(0, pos[first] - P.BEFORE)[run - 1],
                high=(pos[last] + size[last] + P.BEHIND)[run - 1],
                **symbols,
                covers=sum(sizes),
                short=(ahead(run, NAMED - 1) == run) & (ahead(covers.end, NAMED - 1) - covers.begin < P.LENGTH),
            )

    dealt = rows.repartition(fan_out(rows.sparkSession), "text").sortWithinPartitions("text", "place")
    # a zone below 400 bytes has no repeat
    return dealt.mapInPandas(keys, RUNS).filter(F.col("high") - F.col("low") >= P.LENGTH)


def reached(runs: DataFrame) -> DataFrame:
    """`runs` with `reach`: how many bytes of phrases some other place shares, as far as REACHES
    tell, seen from the neighbours in the order of all suffixes."""
    ordered = runs.filter("ordered")
    strings = ordered.select("text", "at", F.col("name").alias("sym"), "sym1", "sym2", kind(), "covers")
    ranks = ranks_of(strings, P.LENGTH, LEVELS)
    keys = [*(f"key{c}" for c in REACHES), "second"]

    def shared(alike: list[Column]) -> Column:
        return F.greatest(F.lit(0), *[F.when(a, c) for a, c in zip(alike, REACHES, strict=True)])

    # a place that only repeats the next one is represented by the last of them
    compared = ordered.filter("base").select("text", "at", *keys)
    groups = ranks.hint("shuffle_hash").join(compared, ["text", "at"]).groupBy("rank")
    # places that share a rank for want of bytes in nine phrases may differ further on
    same = [(F.min(k).eqNullSafe(F.max(k))) & (F.count(k).isin(0, F.count("*"))) for k in keys]
    alike = reduce(lambda a, b: a & b, same).alias("alike")
    groups = groups.agg(F.count("*").alias("n"), alike, *[F.min(k).alias(k) for k in keys])
    # ranks in order are neighbours: numbered, each is joined with the next
    groups = groups.withColumn("nth", F.lit(1).cast("long"))
    found = stored(numbered(groups, ["rank"], ["nth"]))
    after = found.select((F.col("nth") - 1).alias("nth"), *[F.col(k).alias(f"next_{k}") for k in keys])
    pairs = found.select("nth", *keys).join(after.hint("shuffle_hash"), "nth")

    equal = [F.col(k) == F.col(f"next_{k}") for k in keys]
    equal = [*equal[:-2], equal[-2] & equal[-1]]
    pairs = pairs.select("nth", shared(equal).alias("shared")).filter("shared > 0")
    both = pairs.select(F.explode(F.array("nth", F.col("nth") + 1)).alias("nth"), "shared")
    both = both.groupBy("nth").agg(F.max("shared").alias("shared")).hint("shuffle_hash")
    whole = shared([F.col(k).isNotNull() for k in keys[:-1]])
    # of these nothing is sure, and all starts before them are compared
    among = F.when(~F.col("alike"), REACHES[-2]).when(F.col("n") > 1, F.col("whole")).otherwise(0)
    shared_most = F.coalesce("shared", F.lit(0))
    shared_most = F.when(F.col("alike"), shared_most).otherwise(F.least(shared_most, F.lit(REACHES[-2])))
    reach = F.greatest(among, shared_most).alias("reach")
    found = found.select("rank", "nth", "n", "alike", whole.alias("whole"))
    found = found.join(both, "nth", "left").select("rank", reach).filter("reach > 0").hint("shuffle_hash")
    places = ranks.join(found, "rank").select("text", "at", "reach").hint("shuffle_hash")
    reach = F.coalesce(F.when(F.col("base"), F.col("reach")), F.lit(0))
    # places that agree in nine short phrases have no sure neighbours: all starts before them are compared
    reach = F.greatest(reach, F.when(F.col("short"), REACHES[-2]))
    reach = F.when(F.col("given"), P.LENGTH).otherwise(reach)
    rows = runs.join(places, ["text", "at"], "left").withColumn("reach", reach)
    kept = ["text", "at", "pos", "name", "around", "ordered", "low", "high", "reach"]
    return rows.select(*kept, (F.col("reach") == P.LENGTH).alias("sure"))


def covered(rows: DataFrame) -> DataFrame:
    """`reached` rows with the chain of neighbouring sure phrases and its first place."""
    order = Window.partitionBy("text", "sure").orderBy("at")
    rows = rows.withColumn("chain", F.when(F.col("sure"), F.col("at") - F.row_number().over(order)))
    return rows.withColumn(
        "chain_low", F.min("pos").over(Window.partitionBy("text", "sure", "chain"))
    )


def open_ranges(rows: DataFrame) -> DataFrame:
    """(text, ranges): starts to compare exactly, before phrases that aren't inside a chain. What lies
    inside one is compared, for the others' sake, once for each different surrounding."""
    rows = rows.filter("ordered and reach > 0").withColumn("first", F.greatest(F.col("low"), F.col("pos") - P.BEFORE))
    inside = F.col("sure") & (F.col("chain_low") <= F.col("first"))
    rows = rows.withColumn("inside", inside)
    edges = rows.filter("not inside")
    names = edges.select("name").distinct()
    others = rows.filter("inside").join(names, "name", "left_semi")
    near = edges.select("text", "pos", "first", "high", "reach").unionByName(
        others.filter("around is null").select("text", "pos", "first", "high", "reach")
    )
    others = others.filter("around is not null").dropDuplicates(["around"])
    near = near.unionByName(others.select("text", "pos", "first", "high", "reach"))
    # a start far in front of a phrase needs fewer bytes behind it
    least = F.greatest(F.lit(0), P.LENGTH - P.BEHIND + 1 - next_reach(F.col("reach")))
    near = near.withColumn("last", F.least(F.col("pos") - least, F.col("high") - P.LENGTH))
    near = near.filter(F.col("first") <= F.col("last")).groupBy("text")
    # as many as the phrases of one text
    pos = F.col("pos").cast("long")
    packed = pos * (1 << 16) + (pos - F.col("first")) * 256 + pos - F.col("last")
    return near.agg(F.collect_list(packed.cast("long")).alias("ranges"))


def next_reach(reach: Column) -> Column:
    """The first of REACHES that isn't shared; what is shared in truth is less."""
    out = F.lit(REACHES[-1])
    for c, following in zip(REACHES, REACHES[1:], strict=False):
        out = F.when(reach == c, following).otherwise(out)
    return out


def packed() -> Column:
    """A range of bytes as one number."""
    return F.col("first") * (1 << 32) + F.col("last")


def unpacked(ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ranges >> 32, ranges & 0xFFFFFFFF


def union_of(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """All numbers below n in the ranges, each once."""
    first, last = np.minimum(first, n), np.minimum(last + 1, n)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, last, -1)
    return np.flatnonzero(np.cumsum(depth[:n]) > 0)


def block_rows(ranged: DataFrame) -> DataFrame:
    """(text, high, low, last, core, hull1, hull2): the starts before a phrase in blocks of 32, counted
    from the phrase; `core` is what all 400-byte pieces from a block share, `hull` all their bytes."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for row in batch.itertuples(index=False):
                content = row.content.encode()
                pos = row.ranges >> 16
                first, last = pos - (row.ranges >> 8 & 255), pos - (row.ranges & 255)
                last = np.minimum(last, len(content) - P.LENGTH)
                high = (pos[:, None] - BLOCK * np.arange(-(-P.WINDOW // BLOCK))).ravel()
                each = len(high) // len(pos)
                low = np.maximum(np.repeat(first, each), high - BLOCK + 1)
                last = np.minimum(np.repeat(last, each), high)
                some = low <= last
                # a block may belong to two phrases
                high, at = np.unique(high[some], return_inverse=True)
                lows, lasts = np.full(len(high), len(content)), np.full(len(high), -1)
                np.minimum.at(lows, at, low[some])
                np.maximum.at(lasts, at, last[some])
                if not len(high):
                    continue
                hashes = P.Windows(content)
                start, size = high - BLOCK + 1, P.LENGTH + BLOCK - 1
                whole = (start >= 0) & (start + size <= len(content))
                safe = np.where(whole, start, 0)
                size = min(size, len(content))
                core = hashes.one(high, P.LENGTH - BLOCK + 1)
                hull = hashes.one(safe, size), hashes.two(safe, size)
                parts.append((np.full(len(high), row.text), high, lows, lasts, core, *hull, whole))
            if parts:
                *values, whole = (np.concatenate(x) for x in zip(*parts, strict=True))
                out = pd.DataFrame(dict(zip(BLOCKS, values, strict=True)))
                for hull in ("hull1", "hull2"):
                    out[hull] = column(out[hull].to_numpy(), whole, out)
                yield out

    return ranged.mapInPandas(rows, ", ".join(f"{name} long" for name in BLOCKS))


def split_blocks(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of the blocks whose hull occurs twice; (text, ranges) of the starts left to compare: those
    of the other blocks whose core occurs twice, and of one block of each hull they may meet."""
    hulls = blocks.filter("hull1 is not null").groupBy("hull1", "hull2").agg(F.count("*").alias("n"))
    hulls = hulls.filter("n > 1").select("hull1", "hull2", F.lit(True).alias("twice"))
    # different hulls and cores: an even share of them in each task, so the blocks need no sort
    hulls = hulls.hint("shuffle_hash")
    blocks = stored(
        blocks.join(hulls, ["hull1", "hull2"], "left").withColumn(
            "twice", F.coalesce("twice", F.lit(False))
        )
    )
    start = F.col("high") - BLOCK + 1
    spans = blocks.filter("twice").select(
        "text", start.alias("first"), (F.col("high") + P.LENGTH - 1).alias("last")
    )
    cores = blocks.groupBy("core").agg(F.count("*").alias("n"), F.min("twice").alias("all_twice"))
    cores = cores.filter("n > 1 and not all_twice").select("core").hint("shuffle_hash")
    left = blocks.join(cores, "core", "left_semi")
    one = left.filter("twice").dropDuplicates(["hull1", "hull2"])
    left = left.filter("not twice").select("text", F.col("low").alias("first"), "last")
    left = left.unionByName(one.select("text", start.alias("first"), F.col("high").alias("last")))
    # as many as the blocks of one text
    return spans, left.groupBy("text").agg(F.collect_list(packed()).alias("ranges"))


def window_rows(ranged: DataFrame) -> DataFrame:
    """(hash1, hash2, text, start) of the 400 bytes from every start in the ranges."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for row in batch.itertuples(index=False):
                content = row.content.encode()
                starts = union_of(*unpacked(row.ranges), len(content) - P.LENGTH + 1)
                if len(starts):
                    hashes = P.Windows(content)
                    both = hashes.one(starts, P.LENGTH), hashes.two(starts, P.LENGTH)
                    parts.append((*both, np.full(len(starts), row.text), starts))
            if parts:
                columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
                yield pd.DataFrame(dict(zip(("hash1", "hash2", "text", "start"), columns, strict=True)))

    return ranged.mapInPandas(rows, "hash1 long, hash2 long, text long, start int")


def results(held: DataFrame, spans: DataFrame) -> DataFrame:
    """RESULT for the texts in `held` (text, content) and their `spans` (first, last)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                raw = np.frombuffer(row.content.encode(), np.uint8)
                gone = np.zeros(len(raw), bool)
                gone[union_of(*unpacked(row.spans), len(raw))] = True
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = hashlib.sha256(raw[~gone].tobytes()).hexdigest()
                out.append((row.text, int(gone.sum()), spans, kept))
            yield pd.DataFrame(out, columns=["text", "n_removed", "n_spans", "kept_sha256"])

    listed = spans.groupBy("text").agg(F.collect_list(packed()).alias("spans"))
    return held.join(listed, "text").mapInPandas(rows, RESULT)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = texts(docs)
    raw = F.col("text").cast("binary")
    sums = stored(
        docs.select(
            "doc_id", text_key().alias("text"), F.sha2(raw, 256).alias("sha"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        )
    )
    copies = sums.groupBy("sha").agg(F.min("text").alias("first_text"), F.count("*").alias("n_copies"))
    copies = stored(copies.filter("n_copies > 1"))
    copied = sums.join(copies, "sha").select("text", "first_text")
    # written, so that Spark knows its size before it plans the join with all phrases
    later = stored(copied.filter(F.col("text") != F.col("first_text")).select("text").distinct())

    again = sums.groupBy("text").agg(F.count("*").alias("n")).filter("n > 1")

    def all_runs() -> DataFrame:
        # copies of a text go before anything is made of their phrases
        rows = stored(phrase_rows(docs).join(later, "text", "left_anti"))
        if not again.isEmpty():
            # repeated rows, with their ids
            rows = stored(rows.dropDuplicates(["text", "place"]))
        return runs_of(repeated(rows))

    runs = settled(all_runs)
    rows = settled(lambda: covered(reached(runs)))

    chains = rows.filter("sure").groupBy("text", "chain").agg(
        F.min("pos").cast("long").alias("first"), (F.max("pos") + P.LENGTH - 1).cast("long").alias("last")
    )
    ranges = stored(open_ranges(rows))
    chains = stored(chains.select("text", "first", "last"))
    wanted = ranges.select("text").union(chains.select("text")).distinct()
    held = docs.select(text_key().alias("text"), F.col("text").alias("content"))
    held = stored(held.join(wanted, "text", "left_semi").dropDuplicates(["text"]))

    blocks = stored(block_rows(held.join(ranges, "text")))
    spans, ranges = split_blocks(blocks)
    starts = stored(window_rows(held.join(ranges, "text")))
    twice = starts.groupBy("hash1", "hash2").agg(F.count("*").alias("n")).filter("n > 1")
    hits = starts.join(twice.select("hash1", "hash2").hint("shuffle_hash"), ["hash1", "hash2"]).select(
        "text",
        F.col("start").cast("long").alias("first"),
        (F.col("start") + P.LENGTH - 1).cast("long").alias("last"),
    )
    found = results(held, chains.unionByName(spans).unionByName(hits))

    known = sums.join(copies.select("sha", "n_copies"), "sha", "left").join(found, "text", "left")
    twin = F.col("n_copies").isNotNull() & (F.col("n_bytes") >= P.LENGTH)
    zero = F.lit(0).cast("long")
    return known.select(
        "doc_id",
        "n_bytes",
        F.when(twin, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(twin, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(twin, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("kept_sha256", "sha"))
        .alias("kept_sha256"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
ORACLE: dict[str, str] = {}
