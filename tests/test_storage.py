"""The stored fact: parts that a run replaces, what is read and written, what readers see."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from periodica.operators.integrity import integrity_report
from periodica.operators.metrics import run_metrics
from periodica.operators.scd2 import scd2_snapshot, scd2_versions
from periodica.operators import dims, joins
from periodica.plans import analyses
from periodica.plans.build import LOADED, NOTHING, WITHDRAWN, merge_month, run_build
from periodica.plans.warehouse import FACT, Part, Staged, Warehouse, slot_of
from periodica.schemas import HISTORY_SOURCE, STOCK_SOURCE, TABLES
from periodica.session import shared_folder
from periodica.sources import derived
from periodica.sources.register import headcount_bands, scan_history, scan_stock
from periodica.streaming.chunks import LoadState, load_chunks

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2026, 1, 1)
FACT_COLUMNS = [f.name for f in TABLES[FACT].fields]


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df):
    """Rows that the scans of an executed plan let through."""
    df.collect()
    found, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture(scope="module")
def register(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("register")
    derived.source_stock(spark, SF).select(STOCK_SOURCE.names).write.parquet(f"{root}/stock")
    history = derived.source_history(spark, SF).select(HISTORY_SOURCE.names)
    history.repartition(3, "dateDebut").write.parquet(f"{root}/history")
    return f"{root}/stock", f"{root}/history"


@pytest.fixture(scope="module")
def built(spark, register, tmp_path_factory):
    """A warehouse of the country, for tests that only read."""
    root = str(tmp_path_factory.mktemp("built") / "w")
    build = run_build(spark, *register, root, as_of=AS_OF)
    assert build.status == LOADED
    return Warehouse(spark, root), build


def test_observed_metrics_are_those_of_the_stored_fact(spark, register, built):
    warehouse, build = built
    stock, history = scan_stock(spark, register[0]), scan_history(spark, register[1])
    profile = dims.period_profile(joins.restrict_history(history, stock))
    expected = run_metrics(stock, profile, dims.dim_commune(stock), warehouse.read(FACT))
    assert rows(build.metrics) == rows(expected)


def test_a_run_writes_and_never_reads_the_fact(spark, register, tmp_path, monkeypatch):
    """Counts come from the write: a country run never asks for the stored fact."""
    asked = []
    monkeypatch.setattr(
        Warehouse, "read", lambda self, table, read=Warehouse.read: asked.append(table) or read(self, table)
    )
    run_build(spark, *register, str(tmp_path / "w"), as_of=AS_OF)
    assert asked and FACT not in asked


def test_questions_per_establishment_need_no_shuffle(built):
    fact = built[0].read(FACT)
    for question in (analyses.creations_per_year, analyses.closures_per_year, analyses.net_balance):
        text = plan(question(fact))
        assert "Bucketed: true" in text
        assert not re.search(r"hashpartitioning\(siret", text), question


def test_a_lookup_reads_one_bucket_and_asks_bloom_filters(built):
    fact = built[0].read(FACT)
    siret = fact.first()["siret"]
    found = analyses.entity_history(fact, siret)
    assert found.count() > 0
    slot = fact.filter(F.col("siret") == siret).first()["slot"]
    assert scanned_rows(found) <= fact.filter(F.col("slot") == slot).count()
    # inside the bounds of the row groups, and in none of them
    bounds = fact.agg(F.min("siret"), F.max("siret")).first()
    absent = siret[:-1] + "x"
    assert bounds[0] < absent < bounds[1]
    assert scanned_rows(analyses.entity_history(fact, absent)) == 0


def test_slots_are_the_buckets_of_the_files(spark, built):
    fact = built[0].read(FACT).withColumn("file", F.input_file_name())
    bucket = F.regexp_extract("file", r"_(\d{5})\.c", 1).cast("int")
    buckets = built[0].buckets
    wrong = (bucket != F.col("slot")) | (slot_of("siret", buckets) != F.col("slot"))
    assert fact.filter(wrong).isEmpty() and not fact.isEmpty()


class Broken(RuntimeError):
    pass


def break_off(monkeypatch, at):
    """The next publication of the fact stops before its line is written."""

    def announce(self, table, state, n, old=Warehouse._announce):
        if table == FACT and at(state):
            raise Broken
        return old(self, table, state, n)

    monkeypatch.setattr(Warehouse, "_announce", announce)


def test_a_broken_run_leaves_the_old_state(spark, register, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    run_build(spark, *register, root, ["69"], as_of=AS_OF)
    warehouse = Warehouse(spark, root)
    held = warehouse.read(FACT)
    before = rows(held)
    with monkeypatch.context() as patch:
        break_off(patch, lambda state: state.version > 0)
        with pytest.raises(Broken):
            run_build(spark, *register, root, ["69", "70", "71"], as_of=AS_OF)
    # the files of some departments lie there, nobody sees them, and a reader can go on
    assert rows(Warehouse(spark, root).read(FACT)) == before == rows(held)
    run_build(spark, *register, root, ["69", "70", "71"], as_of=AS_OF)
    stock = scan_stock(spark, register[0], ["69", "70", "71"])
    expected = rows(scd2_versions(scan_history(spark, register[1]), stock))
    assert rows(Warehouse(spark, root).read(FACT), *FACT_COLUMNS) == expected
    # a plan made before still reads the state it was made for
    assert rows(held) == before


def test_other_departments_keep_their_files(spark, register, tmp_path):
    root = str(tmp_path / "w")
    run_build(spark, *register, root, ["69", "70"], as_of=AS_OF)
    warehouse = Warehouse(spark, root)
    before = {p for p in warehouse.state(FACT).parts if p.departement == "70"}
    run_build(spark, *register, root, ["69"], as_of=AS_OF)
    after = warehouse.state(FACT)
    assert {p for p in after.parts if p.departement == "70"} == before
    assert {p.version for p in after.parts if p.departement == "69"} == {after.version}


@pytest.mark.parametrize("departements", [None, ["98"]])
def test_an_empty_run_touches_nothing(spark, register, tmp_path, departements):
    root, empty = str(tmp_path / "w"), str(tmp_path / "empty")
    run_build(spark, *register, root, ["69"], as_of=AS_OF)
    warehouse = Warehouse(spark, root)
    before = {table: warehouse.state(table) for table in TABLES}, warehouse.last_load()
    spark.read.parquet(register[1]).limit(0).write.parquet(empty)
    history = register[1] if departements else empty
    build = run_build(spark, register[0], history, root, departements, as_of=dt.date(2026, 5, 1))
    assert build.status == NOTHING
    assert ({table: warehouse.state(table) for table in TABLES}, warehouse.last_load()) == before
    assert dict(map(tuple, build.metrics.collect()))["versions"] == 0


def test_an_emptied_department_is_withdrawn(spark, register, tmp_path):
    root, hidden = str(tmp_path / "w"), str(tmp_path / "hidden")
    run_build(spark, *register, root, ["69"], as_of=AS_OF)
    status = F.lit("P").alias("statutDiffusionEtablissement")
    spark.read.parquet(register[0]).withColumn("statutDiffusionEtablissement", status).write.parquet(hidden)
    build = run_build(spark, hidden, register[1], root, ["69"], as_of=AS_OF)
    assert build.status == WITHDRAWN
    assert Warehouse(spark, root).read(FACT).isEmpty()


def folder_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_a_merge_writes_the_parts_it_touches(spark, register, tmp_path):
    root = str(tmp_path / "w")
    run_build(spark, *register, root, as_of=AS_OF)
    warehouse, stock = Warehouse(spark, root), scan_stock(spark, register[0])
    before = warehouse.state(FACT)
    history = scan_history(spark, register[1])
    one = warehouse.read(FACT).first()
    day = F.lit(dt.date(2025, 3, 1)).alias("date_debut")
    batch = history.filter(F.col("siret") == one["siret"]).limit(1)
    batch = batch.withColumns({"date_debut": day, "code_ape": F.lit("99.99Z")})
    written = merge_month(warehouse, history, batch, stock, as_of=AS_OF)
    after = warehouse.state(FACT)
    assert {p[:2] for p in set(after.parts) - set(before.parts)} == {(one["code_departement"], one["slot"])}
    assert written == warehouse.read(FACT).filter(
        (F.col("code_departement") == one["code_departement"]) & (F.col("slot") == one["slot"])
    ).count()
    table = tmp_path / "w" / FACT
    small, large = (folder_bytes(table / f"version={s.version}") for s in (after, before))
    assert 0 < small < large / 20
    expected = rows(scd2_versions(history.unionByName(batch), stock))
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == expected
    assert not warehouse.read("dim_activite").filter("code_ape = '99.99Z'").isEmpty()
    # nothing new, nothing written
    assert merge_month(warehouse, history, batch.limit(0), stock, as_of=AS_OF) == 0
    assert warehouse.state(FACT) == after


def test_a_merge_follows_the_stock(spark, register, tmp_path):
    """Establishments that move, change their band, leave, and enter, without a new period."""
    root, number = str(tmp_path / "w"), F.col("siret").cast("long")
    stock, history = scan_stock(spark, register[0]), scan_history(spark, register[1])
    warehouse = Warehouse(spark, root, buckets=3)
    warehouse.create_schema()
    merge_month(warehouse, history.limit(0), history, stock.filter(number % 5 != 0), as_of=AS_OF)
    commune = F.when(number % 7 == 0, "75001").otherwise(F.col("code_commune"))
    band = F.when(number % 11 == 0, "53").otherwise(F.col("tranche_effectifs"))
    later = stock.filter(number % 3 != 0).withColumns({"code_commune": commune, "tranche_effectifs": band})
    merge_month(warehouse, history, history.limit(0), later, as_of=AS_OF)
    assert warehouse.buckets == 3
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == rows(scd2_versions(history, later))


def test_a_merge_reads_its_periods_twice(spark, register, tmp_path):
    """Once for the keys of what changes, once for the periods; not again for each step."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=3)
    warehouse.create_schema()
    stock, history = scan_stock(spark, register[0]), scan_history(spark, register[1])
    late = F.crc32(F.col("siret").cast("binary")) % 3 == 0
    first, second = history.filter(~late), history.filter(late)

    def counted(periods):
        seen = spark.sparkContext.accumulator(0)

        def rows(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return periods.mapInArrow(rows, periods.schema), seen, 2 * periods.count()

    merge_month(warehouse, first.limit(0), first, stock, as_of=AS_OF)
    (loaded, old, most_old), (batch, new, most_new) = counted(first), counted(second)
    merge_month(warehouse, loaded, batch, stock, as_of=AS_OF)
    assert 0 < old.value <= most_old and 0 < new.value <= most_new
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == rows(scd2_versions(history, stock))


def test_a_part_is_replaced_or_stays(spark, register, tmp_path):
    root = str(tmp_path / "w")
    run_build(spark, *register, root, ["69"], as_of=AS_OF)
    warehouse = Warehouse(spark, root)
    staged = warehouse.stage(FACT, warehouse.read(FACT).select(FACT_COLUMNS))
    assert isinstance(staged, Staged) and all(isinstance(p, Part) for p in staged.parts)
    with pytest.raises(ValueError):
        staged.publish(lambda part: False)
    staged.discard()
    assert not (tmp_path / "w" / FACT / f"version={warehouse.state(FACT).version + 1}").exists()


def test_dimensions_gain_directories_and_are_joined_again(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.create_schema()
    bands = headcount_bands(spark).collect()
    for i, band in enumerate(bands):
        batch = spark.createDataFrame([band], TABLES["dim_tranche_effectifs"])
        assert warehouse.insert("dim_tranche_effectifs", batch) == 1
        assert len(warehouse.state("dim_tranche_effectifs").parts) == i + 1
    more = spark.createDataFrame([("98", "x"), ("99", "y")], TABLES["dim_tranche_effectifs"])
    assert warehouse.insert("dim_tranche_effectifs", more) == 2
    assert len(warehouse.state("dim_tranche_effectifs").parts) == 1
    assert warehouse.insert("dim_tranche_effectifs", more) == 0
    assert warehouse.read("dim_tranche_effectifs").count() == len(bands) + 2
    assert warehouse.vacuum() == len(bands) + 1
    assert warehouse.read("dim_tranche_effectifs").count() == len(bands) + 2


def test_a_chunk_reads_its_slots(spark, register, tmp_path):
    stock, history = scan_stock(spark, register[0]), scan_history(spark, register[1])
    state = LoadState(spark, str(tmp_path / "state"), 8)
    mark = state.fingerprint(stock)
    state.renew(stock, mark, history)
    assert state.is_of(mark)
    slots = [1, 6]
    some = state.periods(slots)
    assert re.search(r"PartitionFilters: \[[^]]*slot#\d+ IN \(1,6\)", plan(some))
    files = {r[0] for r in some.select(F.input_file_name()).distinct().collect()}
    assert files and all(re.search(r"slot=(1|6)/", f) for f in files)
    inside = slot_of("siret", 8).isin(*slots)
    expected = joins.restrict_history(history, stock).filter(inside)
    assert rows(some) == rows(expected)
    assert rows(state.scope(slots)) == rows(stock.filter(inside))
    # the same batch again replaces itself
    chunk = history.filter(inside).limit(7)
    for _ in range(2):
        state.add(chunk, 4)
    assert rows(state.batch(4)) == rows(joins.restrict_history(chunk, stock))
    assert set(state.slots(4)) <= set(slots)
    assert rows(state.periods(slots, without=4)) == rows(expected)


def test_a_chunk_writes_its_parts(spark, register, tmp_path):
    """One more file with a period of one establishment: one part of the fact is written."""
    folder, root = str(tmp_path / "history"), str(tmp_path / "w")
    source = spark.read.parquet(register[1])
    source.coalesce(1).write.parquet(folder)
    stock = scan_stock(spark, register[0])
    warehouse = load_chunks(spark, folder, stock, root, as_of=AS_OF)
    before = warehouse.state(FACT)
    siret = warehouse.read(FACT).first()["siret"]
    more = source.filter(F.col("siret") == siret).limit(1)
    more = more.withColumn("dateDebut", F.lit(dt.date(2025, 1, 1)))
    more = more.withColumn("activitePrincipaleEtablissement", F.lit("99.99Z"))
    more.coalesce(1).write.mode("append").parquet(folder)
    load_chunks(spark, folder, stock, root, as_of=AS_OF)
    assert len(set(warehouse.state(FACT).parts) - set(before.parts)) == 1
    expected = scd2_versions(scan_history(spark, folder), stock)
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == rows(expected)


def test_chunks_with_another_stock(spark, register, tmp_path):
    """Between two calls the stock gains, loses and moves establishments; their past is kept right."""
    folder, root, number = str(tmp_path / "history"), str(tmp_path / "w"), F.col("siret").cast("long")
    source = spark.read.parquet(register[1])
    late = F.col("dateDebut") >= F.lit(dt.date(1996, 1, 1))
    source.filter(~late).coalesce(1).write.parquet(folder)
    stock = scan_stock(spark, register[0])
    load_chunks(spark, folder, stock.filter(number % 4 != 0), root, as_of=AS_OF)
    source.filter(late | F.col("dateDebut").isNull()).coalesce(1).write.mode("append").parquet(folder)
    commune = F.when(number % 7 == 0, "75001").otherwise(F.col("code_commune"))
    later = stock.filter(number % 5 != 0).withColumn("code_commune", commune)
    warehouse = load_chunks(spark, folder, later, root, as_of=AS_OF)
    expected = scd2_versions(scan_history(spark, folder), later)
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == rows(expected)
    # nothing is kept of those that have left
    states = list((tmp_path / "w" / "_checkpoints").glob("*-state"))
    assert len(states) == 1 and len(list(states[0].glob("generation=*"))) == 1
    for what in ("scope", "periods"):
        kept = spark.read.option("recursiveFileLookup", "true").schema("siret string")
        kept = kept.parquet(str(next(states[0].glob("generation=*")) / what))
        assert kept.filter(number % 5 == 0).isEmpty() and not kept.isEmpty()


def test_chunks_when_the_state_is_lost(spark, register, tmp_path):
    """Without its state a load takes the past from the folder."""
    folder, root = str(tmp_path / "history"), str(tmp_path / "w")
    source = spark.read.parquet(register[1])
    late = F.col("dateDebut") >= F.lit(dt.date(1996, 1, 1))
    source.filter(~late).coalesce(1).write.parquet(folder)
    stock, checkpoint = scan_stock(spark, register[0]), str(tmp_path / "one")
    load_chunks(spark, folder, stock, root, as_of=AS_OF, checkpoint=checkpoint)
    LoadState(spark, f"{checkpoint}-state", 8)._folder.delete("")
    source.filter(late).coalesce(1).write.mode("append").parquet(folder)
    warehouse = load_chunks(spark, folder, stock, root, as_of=AS_OF, checkpoint=checkpoint)
    expected = scd2_versions(scan_history(spark, folder), stock)
    assert rows(warehouse.read(FACT), *FACT_COLUMNS) == rows(expected)


def test_the_report_reads_each_table_once(built):
    report = integrity_report(built[0].tables())
    text = plan(report)
    assert text.count("FileScan parquet spark_catalog") == 1
    assert text.count("FileScan parquet") == len(TABLES)


def test_a_snapshot_reads_the_versions_once(built):
    fact = built[0].read(FACT).select(FACT_COLUMNS)
    state = headcount_bands(fact.sparkSession).select(
        F.col("code_tranche").alias("siret"), *[F.lit("x").alias(c) for c in ("code_ape", "etat", "code_commune", "code_tranche")]
    )
    text = plan(scd2_snapshot(fact, state, AS_OF))
    assert text.count("FileScan parquet") == 1
    # one shuffle on siret for all windows, one for the choice among observations
    assert len(re.findall(r"Exchange hashpartitioning\(siret", text)) <= 2
    assert len(re.findall(r"\bSort \[siret#\d+ ASC NULLS FIRST, live", text)) == 1


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(RuntimeError):
        shared_folder(Session())
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_registered_runs_leave_nothing_local(spark):
    assert registry._folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
