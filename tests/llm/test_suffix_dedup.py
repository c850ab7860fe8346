import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from periodica.llm import phrases as P
from periodica.llm.suffix_dedup import column, op10_suffix_dedup, repeated_passages
from periodica.llm.suffix_order import running, suffix_ranks

SF = "/root/testdata/sf0.001"


def brute(texts):
    """(n_bytes, n_removed, n_spans, sha) per text, by counting every 400-byte string."""
    raw = [(t or "").encode() for t in texts]
    places: dict[bytes, list] = {}
    for i, b in enumerate(raw):
        for k in range(len(b) - 399):
            places.setdefault(hashlib.blake2b(b[k : k + 400], digest_size=16).digest(), []).append((i, k))
    gone = [np.zeros(len(b), bool) for b in raw]
    for at in places.values():
        if len(at) > 1:
            for i, k in at:
                gone[i][k : k + 400] = True
    out = []
    for b, g in zip(raw, gone, strict=True):
        spans = int((np.diff(np.concatenate(([0], g.astype(int), [0]))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~g].tobytes()
        out.append((len(b), int(g.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(repeated_passages(docs).collect(), key=lambda r: r.doc_id)
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows]
    assert got == brute(texts)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(spark, seed):
    rng = random.Random(seed)
    passages = [words(rng, rng.randint(60, 160)) for _ in range(5)]
    texts = []
    for _ in range(25):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            cut = rng.randint(0, 60)
            parts += [words(rng, rng.randint(0, 40)), p[cut : len(p) - rng.randint(0, 60)]]
        texts.append("".join(parts))
    base = words(rng, 300)
    for _ in range(8):
        # near copies with edits, parts of each other
        edited = list(base)
        for _ in range(rng.randint(0, 4)):
            edited[rng.randrange(len(edited))] = "#"
        texts.append("".join(edited)[rng.randint(0, 300) :])
    texts += [base, base, base + base, passages[0][:399], passages[0][:400], passages[1]]
    compare(spark, texts)


def test_periodic_texts(spark):
    rng = random.Random(5)
    tail = words(rng, 30)
    texts = ["ha " * 100, "ha " * 400, "ha " * 1000 + tail, words(rng, 20) + "ha " * 700 + tail, "x" * 399,
             "x" * 400, "x" * 401, "y" * 5000 + tail + "y" * 900, "abcdefg" * 60, "abcdefg" * 55 + tail * 3,
             ("lorem ipsum dolor " * 9 + "\n") * 12, ("lorem ipsum dolor " * 9 + "\n") * 5 + tail]
    compare(spark, texts)


def test_surroundings_tell_places_apart():
    """Neighbouring phrases of a period may have the same phrases around, at other places in them."""
    name, length = np.tile(np.array([11, 12, 13, 14]), 8), np.tile(np.array([90, 72, 29, 87]), 8)
    around, whole = P.Covers(name, length, np.ones(32, int)).key(P.LENGTH, before=P.BEFORE)
    found = {(int(k), int(n)) for k, n in zip(around[whole], name[whole], strict=True)}
    assert len({k for k, _ in found}) == len(found) == 4


def test_keys_keep_64_bits():
    """Keys don't depend on whether other rows of the batch lack theirs."""
    values = np.array([(1 << 62) + 1, 5])
    found = column(values, np.array([True, False]), pd.DataFrame(index=[3, 4]))
    assert found.to_list() == [(1 << 62) + 1, pd.NA]


def test_short_phrases(spark):
    """Repeats that begin in more short phrases than the order tells apart."""
    rng, texts = random.Random(6), []
    for n in range(12):
        middle, tail = words(rng, 4)[:20], "vwxyz" * 60
        unit = "".join(rng.sample("abcdefgh", 4))
        texts += [words(rng, 20) + unit * (28 + n) + middle + tail[: 280 - 3 * n] + words(rng, 20),
                  words(rng, 20) + unit * 90 + middle + tail + words(rng, 20)]
    compare(spark, texts)


def test_defined_results(spark):
    rng = random.Random(3)
    long = words(rng, 120)
    rows = [(1, None), (2, ""), (3, "short"), (None, long), (4, long + "!"), (5, words(rng, 20_000)), (6, "é" * 300), (6, "é" * 300)]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, n_bytes string")
    got = repeated_passages(docs).collect()
    assert len(got) == len(rows)
    expected = sorted(zip([r[0] or 0 for r in rows], brute([r[1] for r in rows]), strict=True))
    assert sorted(((r.doc_id or 0), (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == expected
    assert repeated_passages(docs.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op10_suffix_dedup(spark, SF).collect()}
    assert got == dict(zip(docs, brute(docs.values()), strict=True))


def test_suffix_order_is_the_suffix_array(spark):
    rng = random.Random(9)
    strings = {i: [rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(1, 40))] for i in range(12)}
    strings |= {100: [1] * 30, 101: [1] * 20, 102: [1, 2] * 12}
    rows = [(i, k, s, 1) for i, x in strings.items() for k, s in enumerate(x)]
    frame = spark.createDataFrame(rows, "text long, at long, sym long, size long")
    suffixes = {(i, k): tuple(x[k:]) for i, x in strings.items() for k in range(len(x))}
    for depth in (10**9, 5):
        ranks = {(r.text, r.at): r.rank for r in suffix_ranks(frame, depth).collect()}
        assert ranks.keys() == suffixes.keys()
        by_rank = sorted(ranks, key=lambda p: ranks[p])
        for p, q in zip(by_rank, by_rank[1:], strict=False):
            a, b = suffixes[p], suffixes[q]
            if ranks[p] == ranks[q]:
                assert a == b or a[:depth] == b[:depth]
            else:
                assert a <= b or a[:depth] == b[:depth]


def test_boundaries_are_local():
    rng = np.random.default_rng(1)
    body = bytes(rng.integers(97, 123, 3000, dtype=np.uint8))
    inner = set()
    for front in (b"", b"0123456789" * 7, bytes(rng.integers(65, 91, 1000, dtype=np.uint8))):
        start, size, _ = P.phrases(front + body)
        assert size.max() <= P.WINDOW
        at = {int(x) - len(front) for x in start}
        inner.add(frozenset(x for x in at if P.BEFORE <= x < len(body) - P.BEHIND))
    assert len(inner) == 1


def test_running_totals(spark):
    """Totals over all smaller keys, null first, with the totals of the ranges as the only window."""
    keys = [None, None, *range(60), 7, 7]
    rows = spark.createDataFrame([(k, 1 if k is None else k) for k in keys], "key long, n long")
    found = running(rows, ["key"], {"total": F.col("n")})
    got = {r.key: r.total for r in found.collect()}
    assert got[None] == 0 and len(got) == 61
    assert all(got[k] == sum(n if n is not None else 1 for n in keys if n is None or n < k) for k in range(60))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
