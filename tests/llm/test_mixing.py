import re
from collections import Counter

import numpy as np
import pytest

from periodica.llm.mixing import OTHER, PRODUCTION, fit, mixed, op4_mixing, raked, sampled

SF = "/root/testdata/sf0.1"


def brute_topic(text):
    words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
    if 4 * text.count("|") >= words:
        return "table", words
    if 4 * len(re.findall(r"[#$%&]{3}|!!", text)) >= words:
        return "marked", words
    return ("long" if words >= 1000 else "short" if words < 50 else "prose"), words


def test_raking_meets_the_margins():
    cells = np.random.default_rng(1).integers(1, 1000, (5, 4, 3))
    goals = [np.full(5, 0.2), np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.25, 0.25])]
    shares, error = raked(cells, goals)
    assert error < 1e-9
    for axis, goal in enumerate(goals):
        others = tuple(i for i in range(3) if i != axis)
        assert shares.sum(axis=others) == pytest.approx(goal)
    # the fit keeps the interactions of the counts: odds ratios stay
    odds = lambda x: x[0, 0, 0] * x[1, 1, 0] / (x[0, 1, 0] * x[1, 0, 0])
    assert odds(shares) == pytest.approx(odds(cells.astype(float)))


def test_bounds_hold():
    cells = np.random.default_rng(2).integers(1, 1000, (4, 3))
    goals = [np.full(4, 0.25), np.array([0.3, 0.3, 0.4])]
    most = cells / (0.5 * cells.sum())
    shares, error = raked(cells, goals, most)
    assert (shares <= most + 1e-12).all() and error < 1e-6
    assert shares.sum(axis=0) == pytest.approx(goals[1], abs=1e-6)


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op4_mixing(spark, SF).collect()
    assert len(got) == len(docs)
    tokens = Counter()
    for r in got:
        topic, words = brute_topic(docs[r.doc_id].text)
        assert (r.class_topic, r.n_tokens) == (topic, words)
        source, lang = docs[r.doc_id].source, docs[r.doc_id].lang
        assert r.class_source == (source if source in PRODUCTION["source"] else OTHER)
        assert r.class_lang == (lang if lang in PRODUCTION["lang"] else OTHER)
        tokens[r.class_source, r.class_lang, r.class_topic] += words
    mix = {row[:3]: row[3:] for row in fit([(*k, n) for k, n in tokens.items()], PRODUCTION, 0.8).rows}
    total = sum(tokens.values())
    expected, taken = 0.0, 0
    for r in got:
        cell = r.class_source, r.class_lang, r.class_topic
        assert r.cell_tokens == tokens[cell]
        assert r.share == pytest.approx(mix[cell][1])
        assert r.rate == pytest.approx(0.8 * total * r.share / r.cell_tokens)
        assert int(r.rate) <= r.copies <= int(r.rate) + 1
        expected, taken = expected + r.rate * r.n_tokens, taken + r.copies * r.n_tokens
    assert expected == pytest.approx(0.8 * total)
    assert taken == pytest.approx(expected, rel=0.05)
    for at, dimension in enumerate(("source", "lang", "topic")):
        share = Counter()
        for cell, (_, part, _) in mix.items():
            share[cell[at]] += part
        goal = {x: w for x, w in PRODUCTION[dimension].items() if share[x]}
        assert share == pytest.approx({x: w / sum(goal.values()) for x, w in goal.items()}, abs=1e-6)


def test_sample_has_the_target_shares(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # the table's only source can't be held at a fifth here; language and topic can
    targets = {d: PRODUCTION[d] for d in ("lang", "topic")}
    kept = sampled(docs, targets, 0.6)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert len(set(ids)) == len(ids) and len(ids) > 5000
    words = Counter()
    for r in rows:
        words[r.lang] += len(r.text.split())
    total = sum(words.values())
    for lang, weight in PRODUCTION["lang"].items():
        assert words[lang] / total == pytest.approx(weight, abs=0.05)


def test_defined_results(spark):
    rows = [(1, "a b", "x", "en"), (1, "a b", "x", "en"), (None, "c", None, "en"), (2, None, "x", None), (3, "", "x", "en"),
            (4, "w " * 50_000, "y", "zz")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, lang string, rate int")
    targets = {"source": {"x": 0.5, OTHER: 0.5, "absent": 9.0}, "lang": {"en": 1.0, OTHER: 1.0}}
    got = mixed(docs, targets, budget_share=2.0)
    assert got.columns[:5] == docs.columns and got.columns[-1] == "copies"
    found = {(r.doc_id, r.text): r for r in got.collect()}
    assert found[None, "c"].class_source == OTHER and found[2, None].copies == 0 == found[3, ""].copies
    assert found[4, "w " * 50_000].n_tokens == 50_000
    assert {r.rate for r in got.collect()} == {7}
    assert mixed(docs.limit(0), targets).collect() == []
    nothing = mixed(docs, {"source": {"gone": 1.0}, "lang": {"en": 1.0}})
    assert {r.copies for r in nothing.collect()} == {0}
    again = sorted((r.doc_id or 0, r.copies) for r in mixed(docs.repartition(3), targets, 2.0).collect())
    assert again == sorted((r.doc_id or 0, r.copies) for r in got.collect())


def test_what_is_not_listed_keeps_its_share(spark):
    words = "w " * 100
    rows = [(i, words, "web" if i % 4 else None, "nl" if i % 5 else None) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixed(docs, budget_share=0.8).collect()
    assert all(r.rate == pytest.approx(0.8) for r in got)
    assert sum(r.copies for r in got) == pytest.approx(800, abs=60)
    assert sampled(docs).count() == pytest.approx(800, abs=60)
    # what is listed meets its targets within the rest
    cells = [
        (source, lang, "prose", tokens)
        for source, tokens in [("src0", 300), ("src1", 100), (OTHER, 400)]
        for lang in ("en", "de", OTHER)
    ]
    mix = fit(cells, PRODUCTION)
    share = Counter()
    for source, lang, _, _, part, _ in mix.rows:
        share[source] += part
        share[lang, "lang"] += part
    assert mix.error < 1e-9
    assert (share[OTHER], share[OTHER, "lang"]) == pytest.approx((1 / 2, 1 / 3))
    assert share["src0"] / share["src1"] == pytest.approx(0.20 / (0.80 / 19))
    assert share["en", "lang"] / share["de", "lang"] == pytest.approx(0.55 / 0.17)


def test_the_error_is_told(spark, caplog):
    docs = spark.createDataFrame([(i, "a b", "xy"[i > 0], "en") for i in range(9)], "doc_id long, text string, source string, lang string")
    targets = {"source": {"x": 0.9, "y": 0.1}}
    out = mixed(docs, targets, repeats=False)
    assert out.columns[-2:] == ["error", "copies"]
    assert {r.error > 0.5 for r in out.collect()} == {True}
    assert "can't be reached" in caplog.text
    assert all(r.error < 1e-9 for r in mixed(docs, targets).collect())
