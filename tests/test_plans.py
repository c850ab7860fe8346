"""Shape of the physical plans: what is pushed to the scan, what is shuffled, what stays out."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from oracle import ORACLE
from periodica.operators.keys import first_per_key
from periodica.operators.scd2 import scd2_versions
from periodica.plans import analyses
from periodica.plans.models import materialize
from periodica.plans.warehouse import read_fact, write_fact
from periodica.schemas import HISTORY_SOURCE, STOCK_SOURCE
from periodica.sources.register import scan_history, scan_stock

SF = "/root/testdata/sf0.001"
PAST = dt.date(1998, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return re.findall(r"Exchange (?:hash|range)partitioning\(([^)]*)\)", text)


def keys(shuffle):
    return re.sub(r"#\d+L?", "", shuffle)


@pytest.fixture(scope="module")
def register(spark, tmp_path_factory):
    """The two files under their published names."""
    from periodica.sources import derived

    root = tmp_path_factory.mktemp("register")
    derived.source_stock(spark, SF).select(STOCK_SOURCE.names).write.parquet(f"{root}/stock")
    derived.source_history(spark, SF).select(HISTORY_SOURCE.names).write.parquet(f"{root}/history")
    return f"{root}/stock", f"{root}/history"


def test_filters_reach_the_scan(spark, register):
    text = plan(scan_stock(spark, register[0], ["69", "971"]).select("siret"))
    assert "StringStartsWith(codeCommuneEtablissement,69)" in text
    assert "StringStartsWith(codeCommuneEtablissement,971)" in text
    assert "EqualTo(statutDiffusionEtablissement,O)" in text
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "siret",
        "codeCommuneEtablissement",
        "statutDiffusionEtablissement",
    }


def test_versions_plan(spark, register):
    stock, history = scan_stock(spark, register[0]), scan_history(spark, register[1])
    text = plan(scd2_versions(history, stock))
    assert [keys(s) for s in shuffles(text)] == ["siret, 8", "siret, date_debut, 8"]
    # crowded keys are cut before the first shuffle
    assert re.search(r"Exchange hashpartitioning\(siret.*\n.*WindowGroupLimit.*Partial", text)
    assert text.count("Sort [") == 3
    assert "dateFin" not in text


def test_unique_starts_need_one_shuffle(spark, register):
    stock, history = scan_stock(spark, register[0]), scan_history(spark, register[1])
    order = ["date_fin", "etat", "code_ape", "nomenclature_ape"]
    unique = first_per_key(history, ["siret", "date_debut"], order)
    expected = scd2_versions(unique, stock).collect()
    assert Counter(scd2_versions(unique, stock, unique_starts=True).collect()) == Counter(expected)
    text = plan(scd2_versions(history, stock, unique_starts=True))
    assert [keys(s) for s in shuffles(text)] == ["siret, 8"]
    assert text.count("Sort [") == 1


def test_questions_push_to_the_stored_fact(spark, tmp_path):
    path = write_fact(registry._fact(spark, SF), str(tmp_path / "fact"))
    fact = read_fact(spark, path)
    current = plan(analyses.active_now(fact))
    assert "EqualTo(is_current,true)" in current and "EqualTo(etat,A)" in current
    assert "ReadSchema: struct<is_current:boolean,etat:string>" in current
    past = plan(analyses.active_on(fact, PAST))
    assert "LessThanOrEqual(valid_from,1998-01-01)" in past
    assert "EqualTo(siret,00000000000042)" in plan(analyses.entity_history(fact, "00000000000042"))
    one = plan(fact.filter("code_departement = '69'"))
    assert re.search(r"PartitionFilters: \[[^]]*code_departement[^]]*= 69", one)


def test_versions_with_a_large_stock(spark, register):
    """Without broadcast: one more shuffle, of the stock; the versions keep their partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stock, history = scan_stock(spark, register[0]), scan_history(spark, register[1])
        text = plan(scd2_versions(history, stock))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(keys(s) for s in shuffles(text)) == [
        "siret, 8",
        "siret, 8",
        "siret, date_debut, 8",
    ]


def test_top_k_is_no_global_sort(spark):
    text = plan(registry.queries()["q02_top_sectors"](spark, SF))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["q07_sector_growth", "q11_net_balance"])
def test_two_sided_counts_read_the_fact_once(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    assert text.count("orders.parquet") == 1


def test_net_balance_shuffles_the_fact_once(spark, tmp_path):
    registry._fact(spark, SF).write.parquet(str(tmp_path / "fact"))
    text = plan(analyses.net_balance(spark.read.parquet(str(tmp_path / "fact"))))
    assert [keys(s) for s in shuffles(text) if "siret" in s] == ["siret, 8"]


@pytest.fixture
def low_skew_limits(spark):
    """Run-time limits small enough for a test table, and no broadcast."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """Driver tables in which one establishment holds a third of the periods."""
    root, source = tmp_path_factory.mktemp("crowded"), "/root/testdata/sf0.01"
    orders = spark.read.parquet(f"{source}/orders.parquet")
    crowd = F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
    orders.withColumn("o_custkey", crowd).repartition(8).write.parquet(f"{root}/orders.parquet")
    for table in ("customer", "nation"):
        spark.read.parquet(f"{source}/{table}.parquet").write.parquet(f"{root}/{table}.parquet")
    return str(root)


SPLIT = ["scan_all_history", "stock_history_left", "stg_periodes", "normalize_members"]


@pytest.mark.parametrize("name", SPLIT)
def test_crowded_joins_are_split(spark, crowded, low_skew_limits, name):
    query = registry.queries().get(name) or (lambda s, sf: registry._retained(s, sf))
    out = query(spark, crowded)
    n = len(out.collect())
    assert "skew=true" in plan(out) or "isSkew" in plan(out)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert query(spark, crowded).count() == n
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# what goes through files is a scan in the end
COMPUTED = sorted(name for name in ORACLE if not name.startswith("stored_"))


@pytest.mark.parametrize("name", COMPUTED)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
        assert operator not in text, operator


def test_bucketed_fact_needs_no_shuffle_on_siret(spark):
    fact = materialize(registry._fact(spark, SF), "fact_by_siret", "table", bucket_by=(8, "siret"))
    text = plan(analyses.closures_per_year(fact))
    assert not any(s.startswith("siret") for s in shuffles(text))
    assert analyses.closures_per_year(fact, 1995, 2001).agg(F.sum("nb_fermetures")).first()[0] == 252


def test_a_large_department_is_split(spark, crowded, low_skew_limits, tmp_path):
    fact = registry._fact(spark, crowded).withColumn("code_commune", F.lit("69123"))
    path = write_fact(fact, str(tmp_path / "fact"))
    assert len(list((tmp_path / "fact" / "code_departement=69").glob("*.parquet"))) > 1
    assert read_fact(spark, path).count() == fact.count()
