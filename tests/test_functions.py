"""Filters, codes and dates on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from periodica.functions import dates, members, territory
from periodica.functions.dates import OLDEST_PLAUSIBLE, Bounds
from periodica.operators import filters, integrity
from periodica.sources.register import headcount_bands

AS_OF = dt.date(2026, 1, 1)


def values(df, column):
    return [row[column] for row in df.orderBy(F.asc_nulls_first(column)).collect()]


def test_privacy_filter(spark):
    stock = spark.createDataFrame(
        [("001", "O"), ("002", "O"), ("003", "P"), ("004", None)],
        "siret string, statut_diffusion string",
    )
    assert values(filters.diffusible(stock), "siret") == ["001", "002"]


def test_department_filter(spark):
    stock = spark.createDataFrame(
        [("69123",), ("69381",), ("75001",), (None,)], "code_commune string"
    )
    assert filters.in_territory(stock, ["69"]).count() == 2
    assert filters.in_territory(stock, ["69", "75"]).count() == 3
    assert filters.in_commune(stock, "69381").count() == 1
    assert filters.count_prefix(stock, "code_commune", "69").first()["nb"] == 2


def test_date_before_1900(spark):
    history = spark.createDataFrame(
        [(dt.date(2019, 1, 1),), (dt.date(4, 1, 3),)], "date_debut date"
    )
    assert filters.starts_before(history).count() == 1


def test_no_duplicate(spark):
    dim = spark.createDataFrame([("69123",), ("69381",)], "code_commune string")
    row = integrity.distinct_check(dim, "code_commune").first()
    assert row["total"] == row["distincts"] == 2


def test_bands(spark):
    bands = {row["code_tranche"]: row["libelle"] for row in headcount_bands(spark).collect()}
    assert len(bands) == 16
    assert bands["NN"] == "non renseigné"


@pytest.mark.parametrize(
    "given, code", [(None, "69"), ("", "69"), ("1", "01"), ("2a", "2A"), ("971", "971")]
)
def test_department_argument(given, code):
    assert territory.departement_argument(given) == code


def test_no_department():
    with pytest.raises(ValueError):
        territory.departement_argument("6938")


def test_department_of(spark):
    codes = spark.createDataFrame([("69123",), ("97105",), ("2A004",)], "c string")
    assert values(codes.select(territory.departement_of("c").alias("d")), "d") == ["2A", "69", "97"]
    assert values(codes.select(territory.departement_of("c", True).alias("d")), "d") == [
        "2A",
        "69",
        "971",
    ]
    assert filters.in_territory(codes, ["971"], "c").count() == 1


def test_default_members(spark):
    stock = spark.createDataFrame(
        [("69123", "11"), ("6912", "ZZ"), (None, None)],
        "code_commune string, tranche_effectifs string",
    )
    out = members.normalize_stock(stock)
    assert sorted(map(tuple, out.collect())) == [("69123", "11"), ("99999", "NN"), ("99999", "NN")]
    history = spark.createDataFrame(
        [("X", "A", ""), ("", None, "N")], "code_ape string, etat string, nomenclature_ape string"
    )
    assert sorted(map(tuple, members.normalize_history(history).collect())) == [
        ("?", "?", "N"),
        ("X", "A", "?"),
    ]


def test_estimated_jobs(spark):
    codes = spark.createDataFrame(
        [("NN",), (None,), ("ZZ",), ("00",), ("01",), ("53",)], "c string"
    )
    total = codes.select(members.estimated_jobs("c").alias("n")).agg(F.sum("n")).first()[0]
    assert total == 12001.5


def test_date_parts_and_bad_text(spark):
    text = spark.createDataFrame([("2019-11-03",), ("no date",), ("2019-13-01",)], "d string")
    dated = text.select(dates.as_date("d").alias("d")).filter("d IS NOT NULL")
    assert tuple(dated.select(*dates.date_parts("d")).first()) == (2019, 4, 11)


def test_plausible_windows(spark):
    days = [None, dt.date(1899, 12, 31), OLDEST_PLAUSIBLE, dt.date(2000, 1, 1), AS_OF]
    rows = [(start, end) for start in days for end in days]
    history = spark.createDataFrame(rows, "date_debut date, date_fin date")
    bounds = Bounds(OLDEST_PLAUSIBLE, AS_OF)
    middle = dt.date(2000, 1, 1)
    first = filters.plausible_dates(history, bounds, bounds, keep_null_end=False)
    assert {tuple(r) for r in first.collect()} == {(None, middle), (middle, middle)}
    closed = Bounds(OLDEST_PLAUSIBLE, AS_OF, closed=True)
    second = filters.plausible_dates(history, closed, keep_null_start=False)
    assert {r["date_debut"] for r in second.collect()} == {OLDEST_PLAUSIBLE, middle, AS_OF}
    assert second.count() == 15
    assert filters.plausible_dates(history).count() == 25


def test_extreme_years_stay_typed(spark):
    far = spark.sql("SELECT CAST('+10000-01-03' AS DATE) AS date_debut")
    assert far.select(F.year("date_debut").alias("y")).first()["y"] == 10000
