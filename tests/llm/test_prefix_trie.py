import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from periodica.llm import prefix_trie as P

TURNS = "conv_id long, turn long, role string, text string, path string, depth int, run long"


def ordered(turns):
    """Turns of each conversation as (role, text), in order."""
    out = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))

    def place(t):
        digest = hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()[:16]
        return t[0], t[1], digest, len(t[3])

    return {c: [t[2:] for t in sorted(x, key=place)] for c, x in out.items()}


def rebuilt(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = paths.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(paths):
    """Every node as a row of NODE, by its members."""
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)

    def under(a, b):
        return b[: len(a)] == a

    rows = []
    for node, convs in members.items():
        parent = min(members[node[:-1]]) if node else None
        below = [x for x in members if under(node, x)]
        leaves = [x for x in below if not any(y[:-1] == x and y for y in members)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        children = sum(bool(y) and y[:-1] == node for y in members)
        sha = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(convs), len(node), parent, len(convs), children, len(leaves), saved, sha))
    return sorted(rows, key=str)


def compare(spark, turns, rebuild=True):
    wide = [(*t, "p", 1, 2) for t in turns]
    paths = P.conversation_paths(spark.createDataFrame(wide, TURNS))
    expected = ordered(turns)
    if rebuild:
        paths, expected = P.rebuilt(paths), rebuilt(expected)
    got = sorted((tuple(r) for r in P.trie_nodes(paths).collect()), key=str)
    assert got == brute(expected)


def some_turns(rng, convs, most=7, words=3):
    turns = []
    for c in convs:
        for t in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant"])
            turns.append((c, t, role, rng.choice("abc") * rng.randint(1, words)))
    return turns


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    convs = rng.sample(range(450), rng.choice([3, 60, 150]))
    compare(spark, some_turns(rng, convs, most=rng.choice([2, 9]), words=rng.choice([1, 3])))


def test_prefixes_of_one_another(spark):
    """Paths that end inside others, over several slices."""
    turns = [(c, t, "user", "x" * (t % 3)) for c in range(40) for t in range(c % 13 + 1)]
    compare(spark, turns, rebuild=False)
    compare(spark, turns)


def test_one_very_common_conversation(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE", 20)
    turns = [(c, t, "user", "same") for c in range(300) for t in range(2)]
    turns += [(c, t, "user", f"{c}") for c in range(300, 340) for t in range(2)]
    compare(spark, turns)
    compare(spark, turns, rebuild=False)


def test_odd_rows(spark):
    """Null columns, equal turns, repeated rows, turnless results, a long text, large ids."""
    turns = [
        (None, 1, "user", "lost"),
        (100, None, "user", "first"),
        (100, None, None, None),
        (100, 0, "user", ""),
        (100, 0, "", "user"),
        (101, 5, "user", "late"),
        (101, 5, "user", "late"),
        (101, 5, "user", "later"),
        (205, 0, "user", "gone"),
        (206, 0, "user", "y" * 300_000),
        ((1 << 53) + 1, 0, "user", "é"),
        (-105, 1, "user", "n"),
        (-105, 2, "user", "n"),
    ]
    turns += [(107, t, "user", "deep") for t in range(700)]
    turns += [(108, t, "user", "deep") for t in range(690)]
    paths = P.rebuilt(P.conversation_paths(spark.createDataFrame([(*t, "", 1, 2) for t in turns], TURNS)))
    sizes = {r.conv_id: len(r.path) // P.RECORD for r in paths.collect()}
    assert sizes[107] in range(695, 701)
    short = [t for t in turns if t[0] not in (107, 108, -105)]
    compare(spark, short)
    assert P.trie_nodes(paths).filter("depth = 0").first().n_convs == len(sizes)


def test_turnless_conversations_only(spark):
    # nothing is left of a conversation of one turn whose first one is taken from an absent one
    convs = [c for c in range(201, 260) if zlib.crc32(str(c).encode()) % 6 > 0]
    compare(spark, [(c, 0, "user", "x") for c in convs])


def test_empty_table(spark):
    empty = spark.createDataFrame([], TURNS)
    assert P.prefix_trie(empty).count() == 0
    assert P.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", "", 1, 2)], TURNS)).count() == 0


def test_the_order_of_rows_is_no_matter(spark):
    rng = random.Random(5)
    turns = some_turns(rng, range(80))
    df = spark.createDataFrame([(*t, "", 1, 2) for t in turns], TURNS)
    first = P.prefix_trie(df).collect()
    again = P.prefix_trie(df.repartition(5, F.rand(3))).collect()
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str)


def test_searches_against_scans():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        values = rng.integers(0, 5, n)
        values[0] = -1
        minima = P.Minima.of(values)
        start = np.repeat(np.arange(n), 6)
        depth = np.tile(np.arange(6), n)
        left, right = minima.leftmost(start, depth), minima.rightmost(start, depth)
        for s, d, a, b in zip(start, depth, left, right, strict=True):
            low = s
            while low > 0 and values[low] >= d:
                low -= 1
            high = s
            while high + 1 < n and values[high + 1] >= d:
                high += 1
            assert (a, b) == (low, high)
