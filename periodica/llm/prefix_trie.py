"""Prefix trie of conversations from sorted paths, their common prefixes and range minima.

A path is the sequence of a conversation's turns, 20 bytes for each: 16 of the SHA-256 of role and
text and 4 of the text's length. Paths sorted as bytes are sorted turn by turn, and the conversations
that share a prefix stand side by side: a node of the trie is a depth and an interval. Each prefix of
each path is a candidate. It finds the left and the right end of its interval on its own, by binary
search in a sparse table of the minima of neighbours' common prefixes; the candidate that is the
leftmost of its interval stands for the node. In the order of (left end, depth) a subtree is a run of
nodes, so that sums over subtrees are differences and least members are range minima.

Plan: (path, conv_id) is sorted over all tasks; equal paths may be spread over several. Each task does
the above on its slice. Nodes that don't reach an end of the slice are final. Those that do are
prefixes of its first or its last path; these two paths, with what hangs below each of their prefixes
in the slice, go to a single task that runs the same search over them: two paths for each slice,
whatever the number of conversations. Ids that end at such a prefix are hashed in order, in pieces,
one prefix after the other. Turns too are sorted over all tasks and joined in runs before a
conversation is put together, so a conversation with most of the turns is no hot key; its path, 20
bytes a turn, has to fit a row, and the slices have to fit a task (`spark.sql.shuffle.partitions`).

Defined results: turns are ordered by turn, null first; equal ones by the digest of role and text.
Repeated rows are turns like others. A null role or text is empty. Rows with a null conv_id belong to
no conversation. Every conv_id in the table is one, and without a row there is no trie. conv_id minus
conv_id % span is taken as Spark does, towards zero for negative ids. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import fan_out, settled, stored, table

#: Bytes of a turn in a path, and of the digest at its beginning.
RECORD, DIGEST = 20, 16
#: The contract's rebuilding: conversations of one hundred share up to five turns of the first.
SPAN, HEADS = 100, 6
#: Ids are hashed in pieces of about so many bytes.
PIECE = 1 << 16
NONE = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
NODE += " n_leaves long, saved_tokens long, ends_sha256 string"
HERE = ["n_here", "least_here", "leaves_here", "children_here", "saved_here"]
SLICE = f"kind int, slice int, edge int, {NODE}, path binary, piece int, ids binary, "
SLICE += ", ".join(f"{name} array<long>" for name in HERE) + ", ends_here array<string>"
OPEN = f"slice int, edge int, {NODE}, end_key binary"
A_NODE, AN_EDGE, SOME_IDS = 0, 1, 2


@dataclass
class Minima:
    """Sparse table: level j holds the minima of 2**j neighbours."""

    levels: list[np.ndarray]

    @classmethod
    def of(cls, values: np.ndarray) -> Minima:
        levels = [values]
        while 2 << (len(levels) - 1) <= len(values):
            half = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        return cls(levels)

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least of values[low:high], for ranges that aren't empty."""
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low), self.levels[0].dtype)
        for j in np.unique(level):
            at = level == j
            table = self.levels[j]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << j)])
        return out

    def leftmost(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Least place from which all values up to `start`, its own first one apart, reach `depth`."""
        place = start.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            first = place - (1 << j) + 1
            ok = first >= 1
            ok &= self.levels[j][np.where(ok, first, 0)] >= depth
            place = np.where(ok, first - 1, place)
        return place

    def rightmost(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Greatest place up to which all values after `start` reach `depth`."""
        place = start.copy()
        last = len(self.levels[0]) - 1
        for j in range(len(self.levels) - 1, -1, -1):
            end = place + (1 << j)
            ok = end <= last
            ok &= self.levels[j][np.where(ok, place + 1, 0)] >= depth
            place = np.where(ok, end, place)
        return place


def common_turns(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Turns that each path shares with the one before it; the first gets -1."""
    most = np.minimum(size[1:], size[:-1])
    ends = np.cumsum(most)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - most, most)
    same = flat[np.repeat(start[1:], most) + at] == flat[np.repeat(start[:-1], most) + at]
    shared = np.where(same.all(1), NONE, at)
    out = np.full(len(size), -1, np.int64)
    some = np.flatnonzero(most)
    if len(some):
        first = np.minimum.reduceat(shared, (ends - most)[some])
        most[some] = np.minimum(most[some], first)
    out[1:] = most
    return out


class Nodes:
    """Nodes of the trie of sorted paths in the order of (left end, depth), parents before children."""

    def __init__(self, paths: list[bytes]) -> None:
        flat = np.frombuffer(b"".join(paths), np.uint8).reshape(-1, RECORD)
        size = np.array([len(p) // RECORD for p in paths], np.int64)
        start = np.cumsum(size) - size
        words = np.ascontiguousarray(flat).view(np.uint32)
        minima = Minima.of(common_turns(words, start, size))
        # candidate: a path and a depth, from 0 to the path's size
        first = np.cumsum(size + 1) - size - 1
        path = np.repeat(np.arange(len(paths)), size + 1)
        depth = np.arange(len(path)) - first[path]
        left = minima.leftmost(path, depth)
        own = left == path
        self.size, self.first = size, first
        #: node of each candidate
        self.at = (np.cumsum(own) - 1)[first[left] + depth]
        self.left, self.depth = path[own], depth[own]
        self.right = minima.rightmost(self.left, self.depth)
        above = np.maximum(first[self.left] + self.depth - 1, 0)
        self.parent = np.where(self.depth > 0, self.at[above], -1)
        self.end = np.searchsorted(self.left, self.right, "right")
        #: code points of the last turn
        last = np.maximum(start[self.left] + self.depth - 1, 0)
        lengths = flat[:, DIGEST:].copy().view(">u4").astype(np.int64)[:, 0]
        self.length = np.zeros(len(self.left), np.int64)
        deep = self.depth > 0
        self.length[deep] = lengths[last[deep]]

    def below(self, own: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        upto = np.concatenate(([0], np.cumsum(own)))
        return upto[self.end] - upto[:-1]

    def least_below(self, own: np.ndarray) -> np.ndarray:
        return Minima.of(own).between(np.arange(len(own)), self.end)

    def from_children(self, values: np.ndarray) -> np.ndarray:
        """Sums over children, a root has no parent to give to."""
        out = np.zeros(len(self.left), np.int64)
        deep = self.depth > 0
        np.add.at(out, self.parent[deep], values[deep])
        return out

    def path_nodes(self, k: int) -> np.ndarray:
        """The nodes along path k, from the root."""
        return self.at[self.first[k] : self.first[k] + self.size[k] + 1]


@dataclass
class Ends:
    """Paths of one slice and the ids that end there."""

    paths: list[bytes]
    counts: list[int]
    least: list[int]
    digests: list[str]
    #: ids of the first and of the last path, in pieces
    first: list[bytes]
    last: list[bytes]

    @classmethod
    def read(cls, batches: Iterator[pa.RecordBatch]) -> tuple[int, Ends]:
        """Rows sorted by (path, conv_id); the ids of a path are held until the next one comes."""
        out = cls([], [], [], [], [], [])
        number, digest, pieces, piece, size = -1, None, [], [], 0

        def close() -> None:
            if out.paths:
                pieces.append(",".join(piece).encode())
                digest.update(pieces[-1])
                out.digests.append(digest.hexdigest())
                out.last = list(pieces)
                if len(out.paths) == 1:
                    out.first = out.last

        for batch in batches:
            if batch.num_rows:
                number = batch.column("slice")[0].as_py()
            ids = batch.column("conv_id").to_pylist()
            for path, conv in zip(batch.column("path").to_pylist(), ids, strict=True):
                if not out.paths or path != out.paths[-1]:
                    close()
                    out.paths.append(path)
                    out.counts.append(0)
                    out.least.append(conv)
                    digest, pieces, piece, size = hashlib.sha256(), [], [], 0
                text = str(conv)
                if size > PIECE:
                    # the piece that follows begins behind a comma
                    pieces.append((",".join(piece) + ",").encode())
                    digest.update(pieces[-1])
                    piece, size = [], 0
                piece.append(text)
                size += len(text) + 1
                out.counts[-1] += 1
        close()
        return number, out


def batch_of(schema: str, rows: int, columns: dict) -> pa.RecordBatch:
    """A batch with nulls in the columns that aren't given."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds |= {"array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    fields = [field.split() for field in schema.split(", ")]
    arrays = [
        pa.nulls(rows, kinds[kind])
        if name not in columns
        else columns[name].cast(kinds[kind])
        if isinstance(columns[name], pa.Array)
        else pa.array(columns[name], kinds[kind])
        for name, kind in fields
    ]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def slice_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Final nodes, first and last path, and their ids, of one slice: rows of SLICE."""
    number, ends = Ends.read(batches)
    if not ends.paths:
        return
    nodes, last = Nodes(ends.paths), len(ends.paths) - 1
    whole = nodes.size[nodes.left] == nodes.depth
    own_n = np.where(whole, np.array(ends.counts)[nodes.left], 0)
    least = nodes.least_below(np.where(whole, np.array(ends.least, np.int64)[nodes.left], NONE))
    n_convs = nodes.below(own_n)
    is_open = (nodes.left == 0) | (nodes.right == last)
    final = ~is_open
    n_children = nodes.from_children(np.ones(len(whole), np.int64))
    leaves = nodes.below((n_children == 0) & final)
    saved = nodes.below(np.where(final, (n_convs - 1) * nodes.length, 0))

    at = np.flatnonzero(final)
    parent = nodes.parent[at]
    known = final[parent]
    digests = np.array([*ends.digests, NO_ENDS], object)
    yield batch_of(
        SLICE,
        len(at),
        {
            "kind": np.full(len(at), A_NODE),
            "slice": np.full(len(at), number),
            # where the parent is open: on which of the two paths
            "edge": pa.array((nodes.left[parent] > 0).astype(np.int32), mask=known),
            "conv_id": least[at],
            "depth": nodes.depth[at],
            "parent_conv_id": pa.array(least[parent], mask=~known),
            "n_convs": n_convs[at],
            "n_children": n_children[at],
            "n_leaves": leaves[at],
            "saved_tokens": saved[at],
            "ends_sha256": digests[np.where(whole[at], nodes.left[at], -1)],
        },
    )

    def here(values: np.ndarray) -> np.ndarray:
        """What lies below an open node and below no deeper one."""
        return values - nodes.from_children(np.where(is_open, values, 0))

    own = [here(n_convs), least, here(leaves), nodes.from_children(final), here(saved)]
    edges = [0] if last == 0 else [0, last]
    for edge, k in enumerate(edges):
        along = nodes.path_nodes(k)
        # prefixes of both paths are told of by the first
        told = np.full(len(along), True) if edge == 0 else nodes.left[along] > 0
        blank = [0, NONE, 0, 0, 0]
        arrays = [np.where(told, x[along], b).tolist() for x, b in zip(own, blank, strict=True)]
        head = {"kind": [AN_EDGE], "slice": [number], "edge": [edge], "path": [ends.paths[k]]}
        # all ids of a path between the first and the last one are here
        left = nodes.left[along]
        inner = whole[along] & (left > 0) & (left < last)
        at_ends = np.where(inner, digests[left], None)
        head["ends_here"] = [at_ends.tolist()]
        yield batch_of(SLICE, 1, head | {n: [x] for n, x in zip(HERE, arrays, strict=True)})
        pieces = ends.last if edge else ends.first
        key, n = hashlib.sha256(ends.paths[k]).digest(), len(pieces)
        head = {"kind": [SOME_IDS] * n, "slice": [number] * n, "path": [key] * n}
        yield batch_of(SLICE, n, head | {"piece": list(range(n)), "ids": pieces})


def edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes of all slices, and the least member at each prefix of their first and last paths."""
    found = [row for batch in batches for row in batch.to_pylist()]
    if not found:
        return
    nodes = Nodes([row["path"] for row in found])
    n = len(nodes.left)
    own_n, leaves, children, saved = (np.zeros(n, np.int64) for _ in range(4))
    least, digests = np.full(n, NONE), np.full(n, None, object)
    pieced = np.zeros(n, bool)
    for k, row in enumerate(found):
        at = nodes.path_nodes(k)
        for total, name in zip((own_n, leaves, children, saved), ["n_here", *HERE[2:]], strict=True):
            np.add.at(total, at, row[name])
        np.minimum.at(least, at, row["least_here"])
        known = np.array(row["ends_here"], object)
        digests[at[known != None]] = known[known != None]  # noqa: E711
        pieced[at[-1]] = True
    n_convs, least = nodes.below(own_n), nodes.least_below(least)
    children = children + nodes.from_children(np.ones(n, np.int64))
    saved = nodes.below(saved + (n_convs - 1) * nodes.length)
    keys = [
        hashlib.sha256(found[left]["path"][: depth * RECORD]).digest() if some else None
        for left, depth, some in zip(nodes.left, nodes.depth, pieced, strict=True)
    ]
    columns = {
        "conv_id": least,
        "depth": nodes.depth,
        "parent_conv_id": pa.array(least[nodes.parent], mask=nodes.parent < 0),
        "n_convs": n_convs,
        "n_children": children,
        "n_leaves": nodes.below(leaves + (children == 0)),
        "saved_tokens": saved,
        "ends_sha256": digests,
        "end_key": keys,
    }
    yield batch_of(OPEN, n, columns)
    for k, row in enumerate(found):
        at = nodes.path_nodes(k)
        where = {"slice": [row["slice"]] * len(at), "edge": [row["edge"]] * len(at)}
        yield batch_of(OPEN, len(at), where | {"depth": nodes.depth[at], "conv_id": least[at]})


def hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each path, which come in order; pieces of two slices meet at a comma."""
    key, digest, place, found = None, None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["path"] != key:
                if key is not None:
                    found.append((key, digest.hexdigest()))
                key, digest, place = row["path"], hashlib.sha256(), row["slice"]
            if row["slice"] != place:
                digest.update(b",")
                place = row["slice"]
            digest.update(row["ids"])
    if key is not None:
        found.append((key, digest.hexdigest()))
    keys, digests = [x[0] for x in found], [x[1] for x in found]
    yield pa.RecordBatch.from_pydict({"own_key": pa.array(keys, pa.binary()), "sha": digests})


def conversation_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path) of each conversation in `turns` (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    length = F.lpad(F.hex(F.char_length(text)), 2 * (RECORD - DIGEST), "0")
    record = F.unhex(F.concat(F.substring(digest, 1, 2 * DIGEST), length))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        record.alias("record"),
        # repeated rows of one turn are dealt out too
        F.monotonically_increasing_id().alias("nth"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "record", "nth"]
    n = fan_out(turns.sparkSession)
    sorted_turns = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            cuts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else []
            records = batch.column("record").to_pylist()
            ends = [*cuts[1:], len(ids)]
            joined = [b"".join(records[a:b]) for a, b in zip(cuts, ends, strict=True)]
            columns = {
                "run": batch.column("run").take(pa.array(cuts, pa.int64())),
                "conv_id": pa.array(ids[cuts] if len(ids) else [], pa.int64()),
                "path": pa.array(joined, pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    # ascending over the partitions and, within one, over its batches
    run = F.monotonically_increasing_id().alias("run")
    marked = sorted_turns.select(run, "conv_id", "record")
    joined = marked.mapInArrow(runs, "run long, conv_id long, path binary")
    parts = F.array_sort(F.collect_list(F.struct("run", "path")))
    whole = F.aggregate(parts, F.lit(b""), lambda path, part: F.concat(path, part["path"]))
    return joined.groupBy("conv_id").agg(whole.alias("path"))


def rebuilt(paths: DataFrame, span: int = SPAN, heads: int = HEADS) -> DataFrame:
    """`paths` whose first turns, fewer than `heads`, are those of the first conversation of `span`."""
    conv = F.col("conv_id")
    taken = F.crc32(conv.cast("string").cast("binary")) % heads * RECORD
    first = paths.filter(conv % span == 0).select(
        conv.alias("first_id"), F.substring("path", 1, (heads - 1) * RECORD).alias("head")
    )
    # at most `span` conversations have one head
    joined = paths.withColumn("taken", taken.cast("int")).join(
        first, conv - conv % span == F.col("first_id"), "left"
    )
    head = F.substring(F.coalesce("head", F.lit(b"")), F.lit(1), F.col("taken"))
    own = F.substring("path", F.col("taken") + 1, F.length("path"))
    return joined.select("conv_id", F.concat(head, own).alias("path"))


def trie_nodes(paths: DataFrame) -> DataFrame:
    """Per node of the trie of `paths` (conv_id, path) the columns of NODE."""
    n = fan_out(paths.sparkSession)
    in_order = paths.select("path", "conv_id").repartitionByRange(n, "path", "conv_id")
    in_order = in_order.sortWithinPartitions("path", "conv_id")
    slices = in_order.select(F.spark_partition_id().alias("slice"), "path", "conv_id")
    found = stored(slices.mapInArrow(slice_rows, SLICE))

    # two rows for each slice
    edges = found.filter(F.col("kind") == AN_EDGE).select("slice", "edge", "path", *HERE, "ends_here")
    edges = edges.repartition(1).sortWithinPartitions("slice", "edge")
    merged = stored(edges.mapInArrow(edge_rows, OPEN))

    pieces = found.filter(F.col("kind") == SOME_IDS).select("path", "slice", "piece", "ids")
    pieces = pieces.repartition(n, "path").sortWithinPartitions("path", "slice", "piece")
    hashed = pieces.mapInArrow(hash_pieces, "own_key binary, sha string")
    columns = [field.split()[0] for field in NODE.split(", ")]
    open_nodes = merged.filter(F.col("slice").isNull())
    open_nodes = open_nodes.join(hashed, F.col("end_key") == F.col("own_key"), "left")
    open_nodes = open_nodes.withColumn("ends_sha256", F.coalesce("sha", "ends_sha256", F.lit(NO_ENDS)))

    places = merged.filter(F.col("slice").isNotNull()).select(
        "slice", "edge", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above")
    )
    final = found.filter(F.col("kind") == A_NODE)
    inner = final.filter(F.col("edge").isNull())
    outer = final.filter(F.col("edge").isNotNull()).join(places, ["slice", "edge", "depth"])
    outer = outer.withColumn("parent_conv_id", F.col("above"))
    return inner.select(columns).union(outer.select(columns)).union(open_nodes.select(columns))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of the conversations in `turns` (conv_id, turn, role, text)."""
    return settled(lambda: trie_nodes(conversation_paths(turns)))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return settled(lambda: trie_nodes(rebuilt(stored(conversation_paths(turns)))))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLE = {
    "op11_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(text, '') AS text,
                   sha256(length(coalesce(role, '')) || ':' || coalesce(role, '')
                          || coalesce(text, '')) AS sha
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, list({'sha': sha, 'size': length(text)}
                                 ORDER BY turn NULLS FIRST, sha) AS path
            FROM turns GROUP BY conv_id
        ), counted AS (
            -- crc32 of the decimal digits, bit by bit
            SELECT conv_id, path, xor(list_reduce(
                list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                               lambda x: CAST(ascii(x) AS BIGINT)),
                lambda crc, byte: list_reduce(range(8),
                    lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(crc, byte)),
                4294967295), 4294967295) % 6 AS h
            FROM own
        ), rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.path[1:c.h], []), c.path[c.h + 1:]) AS path
            FROM counted c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
        ), prefixes AS (
            SELECT conv_id, d, path[1:d] AS prefix, len(path) = d AS ends
            FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM rebuilt)
        ), nodes AS (
            SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ','
                                              ORDER BY conv_id), '')) AS ends_sha256
            FROM prefixes GROUP BY prefix, d
        ), children AS (
            SELECT prefix[1:d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
        ), counts AS (
            SELECT nodes.*, coalesce(c.n, 0) AS n_children,
                   CASE WHEN d > 0 THEN (n_convs - 1) * prefix[d].size ELSE 0 END AS saved
            FROM nodes LEFT JOIN children c USING (prefix)
        ), below AS (
            SELECT prefix[1:top] AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
                   sum(saved) AS saved_tokens
            FROM (SELECT *, unnest(range(d + 1)) AS top FROM counts) GROUP BY 1
        )
        SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
               n.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens,
               n.ends_sha256
        FROM counts n JOIN below b USING (prefix)
        LEFT JOIN nodes p ON n.d > 0 AND p.prefix = n.prefix[1:n.d - 1]
    """
}
