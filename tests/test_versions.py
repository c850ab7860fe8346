"""Hand-made version cases, the three rule sets, and merges, checked against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from periodica.operators.scd2 import preset, scd2_merge, scd2_snapshot, scd2_versions
from periodica.plans.analyses import active_now, active_on

AS_OF = dt.date(2026, 1, 1)
HISTORY = "siret string, date_debut date, date_fin date, code_ape string, etat string, seq long"
STOCK = "siret string, code_commune string, libelle_commune string, tranche_effectifs string"


def day(text):
    return None if text is None else dt.date.fromisoformat(text if len(text) > 4 else f"{text}-01-01")


def history_of(spark, rows):
    full = []
    for i, (siret, start, end, ape, state, *seq) in enumerate(rows):
        full.append((siret, day(start), day(end), ape, state, seq[0] if seq else i))
    return spark.createDataFrame(full, HISTORY)


def stock_of(spark, sirets):
    return spark.createDataFrame([(s, "69123", "LYON", "11") for s in sorted(sirets)], STOCK)


def versions_of(df, *columns):
    columns = columns or ("siret", "valid_from", "valid_to", "is_current")
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


CASES = {
    "single open period": (
        [("a", "2016", None, "X", "A")],
        [("a", "2016", None, True)],
    ),
    "repeated key": (
        [("b", "2016", "2016-12-31", "X", "A"), ("b", "2017", None, "X", "A")],
        [("b", "2016", None, True)],
    ),
    "sector change": (
        [("c", "2016", "2016-12-31", "X", "A"), ("c", "2017", None, "Y", "A")],
        [("c", "2016", "2017", False), ("c", "2017", None, True)],
    ),
    "close and reopen": (
        [("d", "2016", None, "X", "A"), ("d", "2017", None, "X", "F"), ("d", "2018", None, "X", "A")],
        [("d", "2016", "2017", False), ("d", "2017", "2018", False), ("d", "2018", None, True)],
    ),
    "missing activity": (
        [("e", "2016", None, None, "A"), ("e", "2017", None, None, "A"), ("e", "2018", None, "X", "A")],
        [("e", "2016", "2018", False), ("e", "2018", None, True)],
    ),
    "equal keys in adjacent entities": (
        [("f", "2016", None, "X", "A"), ("g", "2016", None, "X", "A")],
        [("f", "2016", None, True), ("g", "2016", None, True)],
    ),
    "tie on the start date": (
        [("h", "2016", None, "Y", "A", 2), ("h", "2016", None, "X", "A", 1)],
        [("h", "2016", None, True)],
    ),
    "aberrant start": (
        [("i", "0004-01-03", None, "X", "A"), ("i", "2016", None, "Y", "A")],
        [("i", "0004-01-03", "2016", False), ("i", "2016", None, True)],
    ),
    "key with separator": (
        [("k", "2016", None, "X|A", "B"), ("k", "2017", None, "X", "A|B")],
        [("k", "2016", "2017", False), ("k", "2017", None, True)],
    ),
    "no start date": (
        [("l", None, None, "X", "A"), ("l", "2016", None, "Y", "A")],
        [("l", "2016", None, True)],
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_cases(spark, case):
    rows, expected = CASES[case]
    history = history_of(spark, rows)
    out = scd2_versions(history, stock_of(spark, {r[0] for r in rows}))
    assert versions_of(out) == sorted(
        [(s, day(a), day(b), c) for s, a, b, c in expected], key=str
    )


def test_tie_keeps_the_first_arrival(spark):
    rows, _ = CASES["tie on the start date"]
    out = scd2_versions(history_of(spark, rows), stock_of(spark, {"h"}))
    assert versions_of(out, "code_ape") == [("X",)]


def test_other_names_and_tracked_columns(spark):
    rows = [("n", "2016", None, "X", "A"), ("n", "2017", None, "Y", "A"), ("n", "2018", None, "Y", "F")]
    history = history_of(spark, rows).withColumnsRenamed(
        {"siret": "id", "date_debut": "since", "date_fin": "until"}
    )
    stock = stock_of(spark, {"n"}).withColumnRenamed("siret", "id")
    names = {"key": "id", "start": "since", "end": "until"}
    out = scd2_versions(history, stock, **names)
    assert versions_of(out, "siret", "valid_from") == [("n", day(y)) for y in ("2016", "2017", "2018")]
    by_state = scd2_versions(history, stock, tracked=("etat",), **names)
    assert versions_of(by_state, "valid_from", "valid_to", "code_ape") == [
        (day("2016"), day("2018"), "X"),
        (day("2018"), None, "Y"),
    ]


def test_attributes_come_from_the_stock(spark):
    rows, _ = CASES["close and reopen"]
    history = history_of(spark, rows + [("z", "2016", None, "X", "A")])
    out = scd2_versions(history, stock_of(spark, {"d", "without periods"}))
    assert versions_of(out, "siret", "code_commune", "code_tranche") == [("d", "69123", "11")] * 3


def test_shipped_end_dates(spark):
    rows = [
        ("m", "2016", "2016-12-31", "X", "A"),
        ("m", "2017", "2017-12-31", "X", "A"),
        ("m", "2018", None, "Y", None),
    ]
    stock = spark.createDataFrame([("m", "6912", "LYON", "ZZ")], STOCK)
    history = history_of(spark, rows)
    a = scd2_versions(history, stock, **preset("shipped_a", AS_OF))
    assert versions_of(a, "valid_from", "valid_to", "is_current", "code_commune") == [
        (day("2016"), day("2016-12-31"), True, "6912")
    ]
    b = scd2_versions(history, stock, **preset("shipped_b", AS_OF))
    assert versions_of(
        b, "valid_from", "valid_to", "is_current", "code_commune", "code_tranche", "etat"
    ) == [
        (day("2016"), day("2017"), False, "99999", "NN", "A"),
        (day("2018"), None, True, "99999", "NN", "?"),
    ]


# rows / current / current and active / active on 1998-01-01
COUNTS = {
    "sf0.001": {
        "decided": (1192, 135, 86, 93),
        "shipped_a": (1070, 135, 94, 81),
        "shipped_b": (1190, 120, 76, 81),
    },
    "sf0.01": {
        "decided": (12160, 1350, 902, 900),
        "shipped_a": (10944, 1348, 896, 768),
        "shipped_b": (12133, 1189, 770, 777),
    },
}


@pytest.mark.parametrize("sf", COUNTS)
@pytest.mark.parametrize("rules", ["decided", "shipped_a", "shipped_b"])
def test_published_counts(spark, sf, rules):
    fact = registry._fact(spark, f"/root/testdata/{sf}", rules)
    active = F.col("etat") == "A"
    past = F.expr(
        "valid_from <= DATE '1998-01-01' AND (valid_to IS NULL OR valid_to > DATE '1998-01-01')"
    )
    row = fact.agg(
        F.count("*"),
        F.count_if("is_current"),
        F.count_if(F.col("is_current") & active),
        F.count_if(past & active),
    ).first()
    assert tuple(row) == COUNTS[sf][rules]


def brute_versions(rows):
    """Versions by a loop over sorted rows: (siret, from, to, current, ape, state)."""
    out = []
    for siret in sorted({r[0] for r in rows}):
        first = {}
        for r in sorted((r for r in rows if r[0] == siret), key=lambda r: (r[1], r[4])):
            first.setdefault(r[1], r)
        runs = []
        for r in first.values():
            if not runs or (r[2] or "?", r[3] or "?") != (runs[-1][2] or "?", runs[-1][3] or "?"):
                runs.append(r)
        for r, after in zip(runs, runs[1:] + [None]):
            out.append((siret, r[1], after and after[1], after is None, r[2], r[3]))
    return sorted(out, key=str)


def random_rows(seed, entities=40, days=12, periods=400):
    """Random periods; one establishment holds about a third of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(periods):
        siret = "s0" if rng.random() < 0.33 else f"s{rng.randrange(entities)}"
        start = dt.date(2016, 1, 1) + dt.timedelta(days=rng.randrange(days))
        rows.append((siret, start, rng.choice(["X", "Y", None]), rng.choice(["A", "F", None]), i))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "siret string, date_debut date, code_ape string, etat string, seq long"
    )


ALL = ("siret", "valid_from", "valid_to", "is_current", "code_ape", "etat")


@pytest.mark.parametrize("seed", range(3))
def test_random_histories(spark, seed):
    rows = random_rows(seed)
    out = scd2_versions(frame(spark, rows), stock_of(spark, {r[0] for r in rows}))
    assert versions_of(out, *ALL) == brute_versions(rows)


@pytest.mark.parametrize("seed", range(3))
def test_merge_equals_full_build(spark, seed):
    rows = random_rows(seed)
    loaded, batch = rows[:250], [r for r in rows[250:] if r[0] < "s3"]
    stock = stock_of(spark, {r[0] for r in rows} - {"s1"})
    old_stock = stock_of(spark, {r[0] for r in rows})
    merged = scd2_merge(
        scd2_versions(frame(spark, loaded), old_stock),
        frame(spark, loaded),
        frame(spark, batch),
        stock,
    )
    expected = brute_versions([r for r in loaded + batch if r[0] != "s1"])
    assert versions_of(merged, *ALL) == expected


def test_merge_with_another_key(spark):
    rows = random_rows(4)
    key = lambda df: df.withColumnRenamed("siret", "id")
    loaded, batch = frame(spark, rows[:250]), frame(spark, rows[250:])
    stock = stock_of(spark, {r[0] for r in rows})
    old = scd2_versions(loaded, stock.filter("siret <> 's2'"))
    merged = scd2_merge(old, key(loaded), key(batch.filter("siret <> 's2'")), key(stock), key="id")
    kept = [r for r in rows[:250] + rows[250:] if r[0] != "s2" or r in rows[:250]]
    assert versions_of(merged, *ALL) == brute_versions(kept)


def test_snapshot_leaves_the_unobserved_alone(spark):
    history = history_of(spark, [("a", "2016", "2030", "X", "A"), ("b", "2017", "2031", "Y", "A")])
    versions = scd2_versions(history, stock_of(spark, {"a", "b"}), **preset("shipped_b", AS_OF))
    state = versions.limit(0).select("siret", "code_ape", "etat", "code_commune", "code_tranche")
    assert versions_of(scd2_snapshot(versions, state, AS_OF), *ALL) == versions_of(versions, *ALL)


def test_merge_keeps_default_members(spark):
    history = history_of(spark, [("a", "2016", None, "", "A"), ("b", "2016", None, "X", "A")])
    batch = history_of(spark, [("b", "2017", None, "Y", "A")])
    stock = spark.createDataFrame([("a", "69", "L", "ZZ"), ("b", "69", "L", None)], STOCK)
    rules = preset("shipped_b", AS_OF)
    merged = scd2_merge(scd2_versions(history, stock, **rules), history, batch, stock, **rules)
    full = scd2_versions(history.union(batch), stock, **rules)
    columns = (*ALL, "code_commune", "code_tranche")
    assert versions_of(merged, *columns) == versions_of(full, *columns)
    assert {r["code_tranche"] for r in merged.collect()} == {"NN"}


def test_snapshot(spark):
    at = day("2020")
    rows = [
        ("same", "2016", None, "X", "A"),
        ("moved", "2015", None, "W", "A"),
        ("moved", "2016", None, "X", "A"),
        ("gone", "2016", None, "X", "A"),
        ("ahead", "2016", None, "X", "A"),
        ("ahead", "2030", None, "Y", "A"),
        ("today", "2020", None, "X", "A"),
    ]
    sirets = {r[0] for r in rows}
    versions = scd2_versions(history_of(spark, rows), stock_of(spark, sirets))
    state = spark.createDataFrame(
        [
            ("same", "X", "A"),
            ("moved", "Z", "A"),
            ("new", "X", "A"),
            ("ahead", "Z", "F"),
            ("today", "Q", "A"),
        ],
        "siret string, code_ape string, etat string",
    ).withColumns({"code_commune": F.lit("69123"), "code_tranche": F.lit("11")})
    out = scd2_snapshot(versions, state, at)
    assert versions_of(out, "siret", "valid_from", "valid_to", "is_current", "code_ape") == sorted(
        [
            ("same", day("2016"), None, True, "X"),
            ("moved", day("2015"), day("2016"), False, "W"),
            ("moved", day("2016"), at, False, "X"),
            ("moved", at, None, True, "Z"),
            ("gone", day("2016"), None, True, "X"),
            ("ahead", day("2016"), at, False, "X"),
            ("ahead", at, day("2030"), False, "Z"),
            ("ahead", day("2030"), None, True, "Y"),
            ("today", at, None, True, "X"),
            ("new", at, None, True, "X"),
        ],
        key=str,
    )
    again = scd2_snapshot(out, state, at)
    assert versions_of(again, *ALL) == versions_of(out, *ALL)


def test_invariants(spark):
    sf = "/root/testdata/sf0.01"
    fact = registry._fact(spark, sf).cache()
    keys = fact.groupBy("siret", "valid_from").count().filter("count > 1")
    assert keys.isEmpty()
    current = fact.groupBy("siret").agg(F.count_if("is_current").alias("n")).filter("n <> 1")
    assert current.isEmpty()
    fact.createOrReplaceTempView("fact_under_test")
    broken = spark.sql(
        """SELECT * FROM (SELECT *, lead(valid_from) OVER w AS next_from,
             lead(coalesce(code_ape, '?')) OVER w AS next_ape, lead(etat) OVER w AS next_etat
           FROM fact_under_test WINDOW w AS (PARTITION BY siret ORDER BY valid_from))
           WHERE NOT (valid_to <=> next_from)
              OR (next_ape = coalesce(code_ape, '?') AND next_etat = etat)"""
    )
    assert broken.isEmpty()
    late = dt.date(9000, 1, 1)
    assert active_on(fact, late).first()[0] == active_now(fact).first()[0]
    fact.unpersist()
