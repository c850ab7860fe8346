import random
import re

import numpy as np
import pytest

from periodica.llm import setsketch as S
from periodica.llm.components import components
from periodica.llm.near_dedup import near_duplicates, op2_near_dedup, representatives

SF = "/root/testdata/sf0.01"


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(texts, size):
    """Component per document id, over all pairs that share a shingle."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    at = {}
    for i, x in sets.items():
        for s in x:
            at.setdefault(s, []).append(i)
    done = set()
    for group in at.values():
        for k, a in enumerate(group):
            for b in group[k + 1 :]:
                if (a, b) not in done and top(a) != top(b):
                    done.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        low, high = sorted((top(a), top(b)))
                        parent[high] = low
    return {i: top(i) for i in sets}, {i: len(x) for i, x in sets.items()}


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    component, size = brute(texts, 4)
    got = op2_near_dedup(spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == component and len(got) == len(texts)
    assert {r.doc_id: r.n_shingles for r in got} == size
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("tile", [512, 16])
def test_family_of_near_copies(spark, monkeypatch, tile):
    """Copies with more and more edits: chains of links, and unlike labels in the same buckets."""
    monkeypatch.setattr("periodica.llm.near_dedup.TILE", tile)
    rng = random.Random(7)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        texts[1000 - i] = " ".join(words)
    drift = list(base)
    for i in range(40):
        drift[3 * i % 120] = f"d{i}"
        texts[2000 + i] = " ".join(drift)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    component, _ = brute(texts, 4)
    assert len(set(component.values())) > 1
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, shingle=4).collect()}
    assert got == component


def test_defined_results(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a B c"), (9, "A b\tc"), (9, "A b\tc"), (None, "a b c"), (None, "q"),
            (None, "q"), (6, long), (5, long + " x"), (7, "a b")]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, kept string")
    got = sorted(
        (((r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()), key=str
    )
    assert got == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (9, 1, 4, False), (9, 1, 4, False),
         (0, 1, 4, False), (0, 1, None, True), (0, 1, None, True), (6, 29_996, 5, False), (5, 29_997, 5, True),
         (7, 1, 7, True)], key=str)
    left = representatives(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {None, 1, 2, 3, 4, 5, 7}
    assert near_duplicates(docs.limit(0)).collect() == [] == representatives(docs.limit(0)).collect()


def test_components(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, i) for i in range(1001, 1100)]
    links = spark.createDataFrame([*path, *star, (5, 5), (2, 1), (2, 1)], "a long, b long")
    found = {r.node: r.label for r in components(links).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)}
    assert components(links.limit(0)).collect() == []


def test_sketches():
    rng = np.random.default_rng(3)
    for n, j in ((5, 0.0), (50, 0.8), (800, 0.8), (800, 0.3)):
        estimates, plausible = [], []
        for _ in range(40):
            k = round(2 * n * j / (1 + j))
            shared, a, b = (rng.integers(0, 2**63, x).astype(np.uint64) for x in (k, n - k, n - k))
            one, two = (S.registers(np.concatenate((shared, x))) for x in (a, b))
            estimate, ok = S.plausible([(one > two).sum()], [(one < two).sum()], [n], [n], 0.8)
            estimates.append(estimate[0])
            plausible.append(ok[0])
        assert abs(np.mean(estimates) - k / (2 * n - k)) < 0.03
        assert all(plausible) if j == 0.8 else not any(plausible)
    # the sketch of a union has the greater registers
    a, b = (np.unique(rng.integers(0, 2**63, 300).astype(np.uint64)) for _ in range(2))
    assert np.array_equal(S.registers(np.union1d(a, b)), np.maximum(S.registers(a), S.registers(b)))


def test_shingles_are_those_of_the_words():
    for text in ("", " \x0b", "a", "A b  c\td", "é É  x y " * 9, "x " * 1000):
        for size in (4, 5):
            assert len(S.shingle_hashes(text, size)) == len(shingles(text, size))
    assert np.array_equal(S.shingle_hashes("A B c d e", 4), S.shingle_hashes(" a b\nC D E ", 4))
