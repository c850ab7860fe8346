import heapq
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from periodica.llm import pieces as P
from periodica.llm.tokens import MODEL, decoded, encoded, op7_pieces

SF = "/root/testdata/sf0.001"
RAW = Path(MODEL).read_bytes()
WORDS = P.Vocabulary(RAW)
PLAIN = sentencepiece.SentencePieceProcessor(model_proto=RAW)
TEXTS = st.text(st.sampled_from("abcdehinorst  \n.éß日本🙂▁́\x00<>0x"), max_size=60)


def brute(text, key, dropout):
    """The agenda as stated: each candidate is judged when it comes up."""
    if not text:
        return []
    chars = " " + text
    ids = [int(WORDS.symbols(np.array([ord(c)]))[0]) for c in chars]
    parts = [(i, i + 1) for i in range(len(chars))]
    skip, heap = set(), []

    def offer(k):
        if 0 <= k < len(parts) - 1 and ids[k] >= 0 and ids[k + 1] >= 0:
            rank = int(WORDS.rank(np.array([ids[k]]), np.array([ids[k + 1]]))[0])
            if rank != P.NONE:
                heapq.heappush(heap, (rank, parts[k][0], parts[k][1], parts[k + 1][1]))

    for k in range(len(parts)):
        offer(k)
    while heap:
        rank, start, middle, end = heapq.heappop(heap)
        if (start, middle) not in parts or (middle, end) not in parts or (start, middle, end) in skip:
            continue
        place = [np.array([x]) for x in (start, middle, end)]
        if dropout and P.skipped(np.array([key], np.uint64), *place, dropout)[0]:
            skip.add((start, middle, end))
            continue
        k = parts.index((start, middle))
        union = int(WORDS.union(np.array([ids[k]]), np.array([ids[k + 1]]))[0])
        parts[k : k + 2], ids[k : k + 2] = [(start, end)], [union]
        offer(k - 1)
        offer(k)
    out = []
    for i, (a, b) in zip(ids, parts, strict=True):
        out += [i] if i >= 0 else [int(WORDS.byte_ids[x]) for x in chars[a:b].encode()]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=5), st.sampled_from([0.0, 0.1, 0.6, 1.0]), st.integers(0, 2**64 - 1))
def test_agendas_agree(texts, dropout, key):
    keys = np.full(len(texts), key, np.uint64)
    found = P.Segmenter(WORDS, dropout).encode(texts, keys)
    expected = [brute(t, key, dropout) for t in texts]
    assert [x.tolist() for x in found] == expected
    assert [P.decode(WORDS, x) for x in found] == texts
    if dropout == 0:
        own = [PLAIN.encode(t) for t in texts if "▁" not in t and "\x00" not in t]
        assert own == [x for x, t in zip(expected, texts, strict=True) if "▁" not in t and "\x00" not in t]


@pytest.mark.parametrize("dropout", [0.0, 0.2])
def test_long_chunks_by_heap(dropout, monkeypatch):
    text = "".join(chr(97 + (i * i) % 26) for i in range(1500)) + " short " + "ab" * 400
    key = np.full(1, 99, np.uint64)
    by_heap = P.Segmenter(WORDS, dropout).encode([text], key)[0].tolist()
    monkeypatch.setattr(P, "LONG_CHUNK", 10**9)
    assert by_heap == P.Segmenter(WORDS, dropout).encode([text], key)[0].tolist()
    if dropout == 0:
        assert by_heap == PLAIN.encode(text)


def test_query_against_the_library(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    plain = encoded(spark.read.parquet(f"{SF}/documents.parquet"), dropout=0.0).collect()
    assert all(r.pieces == PLAIN.encode(docs[r.doc_id]) for r in plain)
    got = op7_pieces(spark, SF)
    rows = got.collect()
    assert {r.doc_id for r in rows} == docs.keys() and all(r.lossless for r in rows)
    assert all(r.n_pieces == len(r.pieces) and r.n_chars == len(docs[r.doc_id]) for r in rows)
    n_plain = sum(r.n_pieces for r in plain)
    assert 1.02 * n_plain < sum(r.n_pieces for r in rows) < 1.5 * n_plain
    assert {r.doc_id: r.text for r in decoded(got).collect()} == docs


def test_seeds_vary_and_repeat(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    run = lambda seed: {r.doc_id: r.pieces for r in encoded(docs, seed=seed).collect()}
    first, second = run(1), run(2)
    assert first == run(1) and first != second


def test_defined_results(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, "x" * 60_000 + " " + "é日 " * 20_000), (4, "▁"), (4, "▁")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, key string")
    got = encoded(docs)
    found = got.collect()
    assert len(found) == 6 and all(r.lossless for r in found)
    assert [r.n_pieces for r in found if r.doc_id in (1, 2)] == [0, 0]
    back = sorted((r.doc_id or 0, r.text) for r in decoded(got).collect())
    assert back == sorted((i or 0, t or "") for i, t in rows)
    assert encoded(docs.limit(0)).collect() == []
