"""Sources, stored tables, models, pipeline and chunk loading, on files in a fresh folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from periodica.__main__ import arguments, main
from periodica.operators import dims, quality
from periodica.operators.integrity import IntegrityError, integrity_report
from periodica.operators.joins import commune_sample, stock_with_history
from periodica.operators.keys import insert_if_absent
from periodica.operators.metrics import run_metrics
from periodica.operators.scd2 import preset, scd2_versions
from periodica.plans.models import MODELS, PERIODS_SOURCE, Run, materialize
from periodica.plans.build import build_warehouse, merge_month
from periodica.plans.warehouse import FACT, Warehouse, read_fact, write_fact
from periodica.schemas import DIM_COMMUNE, HISTORY_SOURCE, PERIODES, STOCK_SOURCE, TABLES
from periodica.sources import derived
from periodica.sources.register import Sources, headcount_bands, scan_history, scan_stock
from periodica.streaming.chunks import load_chunks

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2026, 1, 1)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=str)


FACT_COLUMNS = [f.name for f in TABLES[FACT].fields]


@pytest.fixture(scope="module")
def register(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("register")
    stock = derived.source_stock(spark, SF).select(STOCK_SOURCE.names)
    history = derived.source_history(spark, SF).select(HISTORY_SOURCE.names)
    stock.coalesce(1).write.parquet(f"{root}/stock")
    history.repartition(3, "dateDebut").write.parquet(f"{root}/history")
    return f"{root}/stock", f"{root}/history"


def expected_fact(spark, register, departements=None, rules="decided"):
    stock = scan_stock(spark, register[0], departements)
    return rows(scd2_versions(scan_history(spark, register[1]), stock, **preset(rules, AS_OF)))


def test_left_join_keeps_entities_without_history(spark):
    stock = spark.createDataFrame([("a", "69123"), ("j", "69123")], "siret string, code_commune string")
    history = spark.createDataFrame([("a", "X"), ("a", "Y"), ("z", "X")], "siret string, code_ape string")
    out = stock_with_history(stock, history)
    assert rows(out) == [("a", "69123", "X"), ("a", "69123", "Y"), ("j", "69123", None)]


def test_sample_and_models(spark, register, tmp_path):
    sample = commune_sample(
        derived.stock(spark, SF), derived.history(spark, SF), "69007"
    ).select(PERIODES.names)
    sample.write.parquet(str(tmp_path / "periodes"))
    sources = Sources(spark).declare(PERIODS_SOURCE, str(tmp_path / "periodes"))
    built = Run(sources).run(MODELS)
    assert built["stg_periodes"].columns[:3] == ["siret", "date_debut", "date_fin"]
    assert built["stg_periodes"].count() == sample.count()
    communes = spark.sql("SELECT * FROM mart_dim_commune")
    assert communes.count() == sample.select("code_commune").distinct().count()


def test_ref_needs_an_earlier_model(spark):
    with pytest.raises(KeyError):
        Run(Sources(spark)).ref("stg_periodes")


def test_materialize(spark):
    bands = headcount_bands(spark)
    assert materialize(bands, "bands_view").count() == 16
    assert materialize(bands, "bands_table", "table").count() == 16
    tables = {t.name: t.isTemporary for t in spark.catalog.listTables()}
    assert tables["bands_view"] and not tables["bands_table"]
    with pytest.raises(ValueError):
        materialize(bands, "x", "snapshot")


def test_labels_of_a_code(spark):
    history = spark.createDataFrame(
        [
            ("X", "Old", dt.date(2000, 1, 1)),
            ("X", "New", dt.date(2010, 1, 1)),
            ("X", "Future", dt.date(3035, 1, 1)),
            ("Y", "Future", dt.date(3035, 1, 1)),
            ("Z", None, dt.date(2010, 1, 1)),
            ("Z", "Old", dt.date(2000, 1, 1)),
            (None, "Old", dt.date(2000, 1, 1)),
        ],
        "code_ape string, nomenclature_ape string, date_debut date",
    )
    assert rows(dims.dim_activite(history, AS_OF)) == [("X", "New"), ("Y", "Future"), ("Z", "Old")]
    stock = spark.createDataFrame(
        [("69123", "B"), ("69123", "A"), ("69123", None), ("75001", None)],
        "code_commune string, libelle_commune string",
    )
    assert rows(dims.dim_commune(stock)) == [("69123", "A", "69"), ("75001", None, "75")]


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame(
        [("a", 2), ("b", 5), ("b", 4), ("c", None), (None, 1)], "k string, v int"
    )
    new = insert_if_absent(old, batch, ["k"])
    assert rows(new) == [("b", 4), ("c", None)]
    assert insert_if_absent(old.union(new), batch, ["k"]).isEmpty()


def test_integrity_rules(spark):
    commune = spark.createDataFrame(
        [("69123", "A", "69"), ("69123", "B", "69"), ("691234", None, "69")],
        ", ".join(f"{f.name} string" for f in DIM_COMMUNE.fields),
    )
    fact = spark.createDataFrame(
        [("s", dt.date(2016, 1, 1), None, True, "75001", None, None, "A")] * 2,
        TABLES[FACT],
    )
    found = integrity_report({"dim_commune": commune, FACT: fact})
    assert rows(found) == sorted(
        [
            ("dim_commune", "primary_key", "code_commune", "69123", 2),
            ("dim_commune", "not_null", "libelle_commune", None, 1),
            ("dim_commune", "max_length:5", "code_commune", None, 1),
            (FACT, "primary_key", "siret,valid_from", "s|2016-01-01", 2),
            (FACT, "foreign_key:dim_commune", "code_commune", "75001", 2),
        ],
        key=str,
    )
    with pytest.raises(IntegrityError):
        integrity_report({"dim_commune": commune}, fail_on_violation=True)


def test_quality_report(spark):
    history = spark.createDataFrame(
        [
            (dt.date(4, 1, 3), dt.date(2000, 1, 1)),
            (dt.date(3035, 1, 1), dt.date(3000, 1, 1)),
            (None, None),
        ],
        "date_debut date, date_fin date",
    )
    row = quality.quality_report(history, AS_OF).first().asDict()
    assert row == {
        "debut_min": dt.date(4, 1, 3),
        "debut_max": dt.date(3035, 1, 1),
        "fin_min": dt.date(2000, 1, 1),
        "fin_max": dt.date(3000, 1, 1),
        "total_lignes": 3,
        "debut_trop_vieux": 1,
        "debut_futur": 1,
        "fin_futur": 1,
        "fin_avant_debut": 1,
    }
    assert quality.undated_periods(history).count() == 1


def test_staged_fact(spark, register, tmp_path):
    stock, history = scan_stock(spark, register[0]), scan_history(spark, register[1])
    fact = scd2_versions(history, stock)
    path = write_fact(fact, str(tmp_path / "fact"))
    assert rows(read_fact(spark, path), *FACT_COLUMNS) == rows(fact)
    # a rerun of one department replaces that one only
    one = scd2_versions(history, scan_stock(spark, register[0], ["69"])).filter("is_current")
    write_fact(one, path)
    back = read_fact(spark, path)
    assert rows(back.filter("code_departement = '69'"), *FACT_COLUMNS) == rows(one)
    others = fact.filter("NOT startswith(code_commune, '69')")
    assert rows(back.filter("code_departement <> '69'"), *FACT_COLUMNS) == rows(others)


def test_department_codes_stay_text(spark, tmp_path):
    fact = spark.createDataFrame(
        [
            ("s1", dt.date(2016, 1, 1), None, True, "01004", None, None, "A"),
            ("s2", dt.date(2016, 1, 1), None, True, "2A004", None, None, "A"),
            ("s3", dt.date(2016, 1, 1), None, True, None, None, None, "A"),
        ],
        TABLES[FACT],
    )
    back = read_fact(spark, write_fact(fact, str(tmp_path / "fact")))
    assert rows(back, "siret", "code_departement") == [("s1", "01"), ("s2", "2A"), ("s3", None)]


def test_empty_schema_and_guard(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.create_schema()
    warehouse.create_schema()
    assert {t: df.count() for t, df in warehouse.tables().items()} == dict.fromkeys(TABLES, 0)
    assert warehouse.publish("dim_tranche_effectifs", headcount_bands(spark)) == 16
    assert warehouse.publish("dim_tranche_effectifs", headcount_bands(spark).limit(0)) == 0
    assert warehouse.read("dim_tranche_effectifs").count() == 16


def test_whole_country(spark, register, tmp_path):
    root = str(tmp_path / "w")
    report = build_warehouse(spark, *register, root, as_of=AS_OF)
    warehouse = Warehouse(spark, root)
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == expected_fact(spark, register)
    metrics = dict(map(tuple, report.collect()))
    assert metrics["versions"] == warehouse.read(FACT).count()
    assert metrics["siret_stock"] == metrics["versions_courantes"] == 135
    # the only broken rule is a band outside the reference list
    found = integrity_report(warehouse.tables())
    assert {(r["rule"], r["key"]) for r in found.collect()} == {
        ("foreign_key:dim_tranche_effectifs", "ZZ")
    }
    # the same run again changes nothing
    before = {t: rows(df) for t, df in warehouse.tables().items()}
    build_warehouse(spark, *register, root, as_of=AS_OF)
    assert {t: rows(df) for t, df in warehouse.tables().items()} == before


def test_departments_one_after_the_other(spark, register, tmp_path):
    root = str(tmp_path / "w")
    for departement in ("69", "70"):
        build_warehouse(spark, *register, root, [departement], as_of=AS_OF)
    together = expected_fact(spark, register, ["69", "70"])
    assert rows(Warehouse(spark, root).read(FACT), *FACT_COLUMNS) == together


def test_default_members_satisfy_every_reference(spark, register, tmp_path):
    root = str(tmp_path / "w")
    build_warehouse(
        spark, *register, root, rules="shipped_b", as_of=AS_OF, fail_on_violation=True
    )
    warehouse = Warehouse(spark, root)
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == expected_fact(
        spark, register, rules="shipped_b"
    )
    assert not warehouse.read("dim_activite").filter("code_ape = '?'").isEmpty()


def test_opted_out_entity_leaves(spark, register, tmp_path):
    root, stock_path = str(tmp_path / "w"), str(tmp_path / "stock")
    build_warehouse(spark, *register, root, ["69"], as_of=AS_OF)
    warehouse = Warehouse(spark, root)
    gone = warehouse.read(FACT).first()["siret"]
    status = F.when(F.col("siret") == gone, "P").otherwise(F.col("statutDiffusionEtablissement"))
    spark.read.parquet(register[0]).withColumn("statutDiffusionEtablissement", status).write.parquet(
        stock_path
    )
    build_warehouse(spark, stock_path, register[1], root, ["69"], as_of=AS_OF)
    assert warehouse.read(FACT).filter(F.col("siret") == gone).isEmpty()
    assert not warehouse.read(FACT).isEmpty()


def test_moved_and_emptied(spark, register, tmp_path):
    """One establishment moves from 69 to 70, then nobody is left to publish in 69."""
    root = str(tmp_path / "w")
    build_warehouse(spark, *register, root, ["69", "70"], as_of=AS_OF)
    warehouse = Warehouse(spark, root)
    mover = warehouse.read(FACT).filter("code_departement = '69'").first()["siret"]
    source = spark.read.parquet(register[0])
    commune, status = "codeCommuneEtablissement", "statutDiffusionEtablissement"
    moved = source.withColumn(
        commune, F.when(F.col("siret") == mover, "70001").otherwise(F.col(commune))
    )
    moved.write.parquet(f"{tmp_path}/moved")
    moved.withColumn(
        status, F.when(F.col(commune).startswith("69"), "P").otherwise(F.col(status))
    ).write.parquet(f"{tmp_path}/emptied")
    build_warehouse(spark, f"{tmp_path}/moved", register[1], root, ["70"], as_of=AS_OF)
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == expected_fact(
        spark, (f"{tmp_path}/moved", register[1]), ["69", "70"]
    )
    build_warehouse(spark, f"{tmp_path}/emptied", register[1], root, ["69"], as_of=AS_OF)
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == expected_fact(
        spark, (f"{tmp_path}/emptied", register[1]), ["70"]
    )


def test_violation_stops_the_publication(spark, register, tmp_path):
    root = str(tmp_path / "w")
    build_warehouse(spark, *register, root, as_of=AS_OF)
    before = rows(Warehouse(spark, root).read(FACT))
    with pytest.raises(IntegrityError):
        build_warehouse(spark, *register, root, ["69"], as_of=AS_OF, fail_on_violation=True)
    assert rows(Warehouse(spark, root).read(FACT)) == before


def test_overseas_departments(spark, register, tmp_path):
    root, commune = str(tmp_path / "w"), F.col("codeCommuneEtablissement")
    moved = spark.read.parquet(register[0]).withColumn(
        "codeCommuneEtablissement",
        F.when(commune.startswith("69"), "97105").when(commune.startswith("70"), "97209").otherwise(
            commune
        ),
    )
    moved.write.parquet(f"{tmp_path}/stock")
    paths = (f"{tmp_path}/stock", register[1])
    for departement in ("971", "972", "971"):
        build_warehouse(spark, *paths, root, [departement], as_of=AS_OF)
    stored = Warehouse(spark, root).read(FACT)
    assert rows(stored, *FACT_COLUMNS) == expected_fact(spark, paths, ["97"])
    assert rows(stored.select("code_departement").distinct()) == [("971",), ("972",)]


def test_unknown_communes_of_several_runs(spark, register, tmp_path):
    root, commune = str(tmp_path / "w"), F.col("codeCommuneEtablissement")
    short = spark.read.parquet(register[0]).withColumn(
        "codeCommuneEtablissement",
        F.when(commune.substr(1, 2).isin("69", "70"), commune.substr(1, 4)).otherwise(commune),
    )
    short.write.parquet(f"{tmp_path}/stock")
    paths = (f"{tmp_path}/stock", register[1])
    for departement in ("69", "70", "71", "70"):
        build_warehouse(spark, *paths, root, [departement], rules="shipped_b", as_of=AS_OF)
    expected = expected_fact(spark, paths, ["69", "70", "71"], rules="shipped_b")
    assert rows(Warehouse(spark, root).read(FACT), *FACT_COLUMNS) == expected


@pytest.mark.parametrize("rules", ["decided", "shipped_b"])
def test_chunks_equal_one_build(spark, register, tmp_path, rules):
    stock = scan_stock(spark, register[0])
    root = str(tmp_path / "w")
    warehouse = load_chunks(
        spark,
        register[1],
        stock,
        root,
        rules=rules,
        as_of=AS_OF,
        checkpoint=str(tmp_path / "checkpoint"),
    )
    # nothing of the history, and so no establishment out of scope, lies in the warehouse
    assert not list((tmp_path / "w").glob("_periods*"))
    hidden = spark.read.parquet(register[0]).filter("statutDiffusionEtablissement = 'P'")
    assert hidden.join(warehouse.read(FACT), "siret").isEmpty() and not hidden.isEmpty()
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == expected_fact(
        spark, register, rules=rules
    )
    dates = dims.dim_date(scan_history(spark, register[1]).join(stock, "siret", "left_semi"))
    assert rows(warehouse.read("dim_date")) == rows(dates)


def test_chunks_again(spark, register, tmp_path):
    """Without a new file nothing happens; another warehouse has its own progress."""
    stock = scan_stock(spark, register[0])
    for root in [str(tmp_path / name) for name in ("w", "w", "other")]:
        warehouse = load_chunks(spark, register[1], stock, root, files_per_chunk=9, as_of=AS_OF)
        assert rows(warehouse.read(FACT), *FACT_COLUMNS) == expected_fact(spark, register)


def test_jobs(spark, register, tmp_path):
    stock, history = register
    paths = ["--stock", stock, "--history", history]
    root, out = str(tmp_path / "w"), str(tmp_path / "out")
    main(["build", "--country", *paths, "--warehouse", root, "--as-of", "2026-01-01"])
    siret = Warehouse(spark, root).read(FACT).first()["siret"]
    years = ["--past", "1998-01-01", "--years", "1995", "2001"]
    main(["analyse", "--warehouse", root, "--out", out, "--siret", siret, *years])
    queries = registry.queries()
    for name in queries:
        if name.startswith("q") and name[1].isdigit() and name != "q08_entity":
            assert rows(spark.read.parquet(f"{out}/{name}")) == rows(queries[name](spark, SF)), name
    versions = Warehouse(spark, root).read(FACT).filter(F.col("siret") == siret).count()
    assert spark.read.parquet(f"{out}/q08_entity").count() == versions
    commune = Warehouse(spark, root).read(FACT).first()["code_commune"]
    main(["sample", commune, *paths, "--out", f"{out}/sample"])
    sample = spark.read.parquet(f"{out}/sample")
    assert sample.columns == PERIODES.names
    assert {r["code_commune"] for r in sample.collect()} == {commune}


def test_default_department():
    args = arguments(["build", "--stock", "s", "--history", "h", "--warehouse", "w"])
    assert args.departements == ["69"]


def test_questions_in_sql(spark, register, tmp_path):
    root = str(tmp_path / "w")
    build_warehouse(spark, *register, root, as_of=AS_OF)
    Warehouse(spark, root).register_views()
    per_year = spark.sql(
        """SELECT EXTRACT(YEAR FROM d)::INTEGER AS annee, count(*) AS nb_creations
           FROM (SELECT siret, min(valid_from) AS d FROM fait_etablissement_version GROUP BY siret)
           WHERE EXTRACT(YEAR FROM d) BETWEEN 1995 AND 2001 GROUP BY annee ORDER BY annee"""
    )
    assert [tuple(r) for r in per_year.collect()] == [(1995, 103), (1996, 27), (1997, 2), (1998, 2)]
    labels = spark.sql(
        """SELECT count(DISTINCT libelle_commune) FROM fait_etablissement_version f
           JOIN dim_commune d ON f.code_commune = d.code_commune WHERE is_current"""
    )
    assert labels.first()[0] > 0


def test_a_month_with_an_opt_in(spark, register, tmp_path):
    """An establishment that the stock has gained gets its whole past with the next month."""
    stock, root = scan_stock(spark, register[0]), str(tmp_path / "w")
    history = scan_history(spark, register[1])
    hidden = F.col("siret").cast("long") % 4 == 0
    warehouse = Warehouse(spark, root)
    warehouse.create_schema()
    late = F.col("siret").cast("long") % 9 == 1
    first, second = history.filter(~late), history.filter(late)
    for loaded, batch, scope in ((first.limit(0), first, stock.filter(~hidden)), (first, second, stock)):
        merge_month(warehouse, loaded, batch, scope, as_of=AS_OF)
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == expected_fact(spark, register)
    with pytest.raises(ValueError):
        merge_month(warehouse, first, second, stock, rules="shipped_b", as_of=AS_OF)
    # opt-out: gone from the table with the next merge, from disk with the old versions
    merge_month(warehouse, history, second.limit(0), stock.filter(~hidden), as_of=AS_OF)
    assert warehouse.vacuum() > 0
    files = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{FACT}")
    assert files.filter(hidden).isEmpty() and not files.isEmpty()
    assert warehouse.vacuum() == 0


def test_merge_of_one_department_keeps_the_others(spark, register, tmp_path):
    root = str(tmp_path / "w")
    build_warehouse(spark, *register, root, ["69", "70"], as_of=AS_OF)
    warehouse, history = Warehouse(spark, root), scan_history(spark, register[1])
    before = rows(warehouse.read(FACT), *FACT_COLUMNS)
    stock = scan_stock(spark, register[0], ["69"])
    merge_month(warehouse, history, history.limit(20), stock, departements=["69"], as_of=AS_OF)
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == before


def test_department_runs_read_their_directories(spark, register, tmp_path):
    root = str(tmp_path / "w")
    build_warehouse(spark, *register, root, ["69"], as_of=AS_OF)
    fact = Warehouse(spark, root).read(FACT)
    stock = scan_stock(spark, register[0], ["69"])
    profile = dims.period_profile(scan_history(spark, register[1]))
    report = run_metrics(stock, profile, dims.dim_commune(stock), fact, ["69"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith(code_departement" in plan or "startswith(code_departement" in plan.lower()


def test_unique_starts_are_checked(spark, tmp_path, register):
    again = str(tmp_path / "history")
    history = spark.read.parquet(register[1])
    history.union(history.limit(3)).write.parquet(again)
    with pytest.raises(IntegrityError):
        build_warehouse(spark, register[0], again, str(tmp_path / "w"), as_of=AS_OF, unique_starts=True)
