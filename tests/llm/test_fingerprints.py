import hashlib
import re

import pytest
from pyspark.sql import functions as F

from periodica.llm.fingerprints import (
    containment, distinct_count, edited_text, fingerprints, merge_parts, merged, op5_fingerprints,
    resemblance, with_next,
)

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_brute_force(spark):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: -r.doc_id)
    got = {r.doc_id: r for r in op5_fingerprints(spark, SF).collect()}
    assert len(got) == len(docs)
    off = []
    by_print = {}
    for row, following in zip(docs, docs[1:] + docs[:1], strict=True):
        half = len(row.text) // 2
        edited = row.text[: len(row.text) - half] + following.text[:half]
        r = got[row.doc_id]
        assert r.n_chars == len(row.text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, new, other = shingles(row.text), shingles(edited), shingles(following.text)
        for value, a, b in ((r.near_edited, own, new), (r.near_next, own, other)):
            if len(a | b) <= 128:
                assert value == pytest.approx(likeness(a, b))
            off.append(abs(value - likeness(a, b)))
        assert by_print.setdefault(row.text, r.fingerprint) == r.fingerprint
        if len(own) < 128:
            assert r.n_shingles == len(own) == len(r.fingerprint.split(","))
        else:
            assert r.n_shingles == pytest.approx(len(own), rel=0.5)
    assert max(off) < 0.2 and sum(off) / len(off) < 0.02


def test_sketches_merge(spark):
    parts = [("x", "a b c d e f"), ("x", "f g h i j k l"), ("x", "a b c d e f"), ("y", ""), (None, "q")]
    docs = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(parts)], "doc_id long, text string, k string")
    found = fingerprints(docs, k=4).join(docs.select("doc_id", "k"), "doc_id")
    whole = {r.k: r.sketch for r in merge_parts(found, "k", k=4).collect()}
    each = {r.doc_id: r.sketch for r in found.collect()}
    assert whole["x"] == sorted(set(each[0]) | set(each[1]))[:4] and whole["y"] == []
    assert whole[None] == each[4]
    pair = spark.createDataFrame([(each[0], each[1])], "a array<bigint>, b array<bigint>")
    row = pair.select(
        merged(F.col("a"), F.col("b"), 4).alias("m"),
        resemblance(F.col("a"), F.col("b"), 4).alias("r"),
        containment(F.col("a"), F.col("a"), 4).alias("c"),
        distinct_count(F.col("a"), 4).alias("n"),
    ).first()
    assert row.m == whole["x"] and row.r == 0 and row.c == 1 and row.n == len(each[0]) == 2


def test_defined_results(spark):
    rows = [(5, "b c"), (5, "a"), (5, "a"), (None, "z"), (7, None), (1, "w " * 60_000), (3, "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, sketch int")
    from periodica.llm.common import texts

    for ranges in (1, 2, 5):
        got = with_next(texts(docs), ranges)
        nexts = sorted((r.doc_id or 0, r.text[:5], r.next_text[:5]) for r in got.collect())
        assert nexts == sorted(
            [(7, "", "a"), (5, "a", "a"), (5, "a", "b c"), (5, "b c", ""), (3, "", "w w w"),
             (1, "w w w", "z"), (0, "z", "")]
        ), ranges
    one = with_next(texts(docs.limit(1)), 3).collect()
    assert [(r.text, r.next_text) for r in one] == [(one[0].text, one[0].text)]
    assert with_next(texts(docs.limit(0)), 3).collect() == []
    edit = docs.limit(1).select(edited_text(F.lit("abcde"), F.lit("x")).alias("e")).first().e
    assert edit == "abcx"


def test_plan_is_native(spark):
    plan = op5_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange shufflepartitionidpassthrough") == 1
