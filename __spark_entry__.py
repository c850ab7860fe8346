"""

The driver's tables hold no register; `periodica.sources.derived` derives the two register files
from customer, nation and orders, and everything below runs on those. Dates are fixed, never today's.
"""

from __future__ import annotations

import datetime as dt
import importlib
import importlib.util
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# the driver may load this file by its path
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import (  # noqa: E402
    COMMUNE,
    DEPARTEMENT,
    FIRST_YEAR,
    LAST_YEAR,
    ORACLE,
    REGION,
    SIRET,
    STORED_DEPARTEMENTS,
)
from periodica.functions.dates import OLDEST_PLAUSIBLE, Bounds  # noqa: E402
from periodica.functions.members import normalize_history, normalize_stock  # noqa: E402
from periodica.operators import dims, filters, integrity, joins, quality  # noqa: E402
from periodica.operators.keys import insert_if_absent as absent_rows  # noqa: E402
from periodica.operators.metrics import run_metrics as metrics  # noqa: E402
from periodica.operators.scd2 import preset, scd2_merge, scd2_snapshot, scd2_versions  # noqa: E402
from periodica.plans import analyses  # noqa: E402
from periodica.plans.build import merge_month, run_build  # noqa: E402
from periodica.plans.models import MODELS, PERIODS_SOURCE, Model, Run, staged_periods  # noqa: E402
from periodica.plans.warehouse import Warehouse  # noqa: E402
from periodica.schemas import HISTORY_SOURCE, PRIMARY_KEYS, STOCK_SOURCE  # noqa: E402
from periodica.session import shared_folder  # noqa: E402
from periodica.sources import derived  # noqa: E402
from periodica.sources.register import (  # noqa: E402
    Sources,
    headcount_bands,
    scan_history,
    scan_stock,
    scope_stock,
)
from periodica.streaming.chunks import load_chunks  # noqa: E402

AS_OF = dt.date(2026, 1, 1)
PAST = dt.date(1998, 1, 1)
EARLY = dt.date(1996, 6, 1)
FACT = "fait_etablissement_version"
Query = Callable[[SparkSession, str], DataFrame]

# the corpus operators and their pipeline may be absent; errors inside them are not hidden
HAS_LLM = importlib.util.find_spec("periodica.llm") is not None
HAS_LLM = HAS_LLM and importlib.util.find_spec("periodica.llm.registry") is not None
LLM = importlib.import_module("periodica.llm.registry") if HAS_LLM else None
HAS_PIPELINE = HAS_LLM and importlib.util.find_spec("corpus_pipeline") is not None
PIPELINE = importlib.import_module("corpus_pipeline") if HAS_PIPELINE else None


def _stock(spark: SparkSession, sf: str, departements: list[str] | None = None) -> DataFrame:
    return scope_stock(derived.stock(spark, sf), departements)


def _fact(spark: SparkSession, sf: str, rules: str = "decided") -> DataFrame:
    history = derived.history(spark, sf, with_end=rules != "decided")
    return scd2_versions(history, _stock(spark, sf), **preset(rules, AS_OF))


def _retained(spark: SparkSession, sf: str, with_end: bool = True) -> DataFrame:
    return joins.restrict_history(derived.history(spark, sf, with_end), _stock(spark, sf))


def _months(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The history in two deliveries: the periods under the old nomenclature, then the others."""
    history = derived.history(spark, sf, with_end=False)
    first = F.col("nomenclature_ape") == "NAFRev1"
    return history.filter(first), history.filter(~first)


def _periods(spark: SparkSession, sf: str) -> DataFrame:
    stock = _stock(spark, sf).withColumnRenamed("tranche_effectifs", "code_tranche")
    return joins.periods_with_stock(stock.drop("code_ape"), derived.history(spark, sf))


def _folder(spark: SparkSession) -> str:
    """A fresh folder that all executors share."""
    return f"{shared_folder(spark)}/register-{uuid.uuid4().hex}"


def _register(spark: SparkSession, sf: str, root: str, files: int | None = None) -> tuple[str, str]:
    """The two files under their published names; the history in some files dealt by date."""
    stock, history = derived.source_stock(spark, sf), derived.source_history(spark, sf)
    stock.select(STOCK_SOURCE.names).write.parquet(f"{root}/stock")
    history = history.select(HISTORY_SOURCE.names)
    history = history if files is None else history.repartition(files, "dateDebut")
    history.write.parquet(f"{root}/history")
    return f"{root}/stock", f"{root}/history"


def stored_scan(spark, sf):
    """The two files read by their paths."""
    stock, history = _register(spark, sf, _folder(spark))
    scope = scan_stock(spark, stock, [DEPARTEMENT])
    return joins.restrict_history(scan_history(spark, history), scope)


def stored_models(spark, sf):
    """A declared source, its staging view and a mart stored as a table, read back together."""
    root = _folder(spark)
    _periods(spark, sf).write.parquet(f"{root}/periodes")
    sources = Sources(spark).declare(PERIODS_SOURCE, f"{root}/periodes")
    staging, mart = MODELS
    name = f"mart_{uuid.uuid4().hex}"
    built = Run(sources).run([staging, Model(name, mart.build, "table")])
    counts = built[staging.name].groupBy("code_commune").agg(F.count("*").alias("nb_periodes"))
    return built[name].join(counts, "code_commune")


def _built(spark, sf, runs: list[list[str] | None]) -> Warehouse:
    root = _folder(spark)
    paths = _register(spark, sf, root)
    for departements in runs:
        run_build(spark, *paths, f"{root}/w", departements, as_of=AS_OF)
    return Warehouse(spark, f"{root}/w")


def stored_fact(spark, sf):
    """A run of the whole country, read back from the warehouse."""
    return _built(spark, sf, [None]).read(FACT).drop("slot")


def stored_departements(spark, sf):
    """Runs of some departments, one of them repeated."""
    first, *others = STORED_DEPARTEMENTS
    return _built(spark, sf, [[first], others, [first]]).read(FACT).drop("slot")


def stored_dims(spark, sf):
    """Dimensions after a run of the country and, on top of it, one of a department."""
    tables = _built(spark, sf, [None, [DEPARTEMENT]]).tables()

    def rows(table: str, *label: str) -> DataFrame:
        key = F.col(PRIMARY_KEYS[table][0]).cast("string").alias("key")
        text = F.concat_ws(" ", *label).alias("label")
        return tables[table].select(F.lit(table).alias("table_name"), key, text)

    found = rows("dim_activite", "nomenclature")
    found = found.union(rows("dim_commune", "libelle_commune", "code_departement"))
    found = found.union(rows("dim_date", "annee", "trimestre", "mois"))
    return found.union(rows("dim_tranche_effectifs", "libelle"))


def stored_guard(spark, sf):
    """Status of runs with and without versions, and how many versions are published after each.

    1: a department. 2: one without establishments. 3: the country, with an empty history. 4: the
    department again, after all its establishments have opted out.
    """
    root = _folder(spark)
    stock, history = _register(spark, sf, root)
    empty, opted_out = f"{root}/empty", f"{root}/opted_out"
    spark.read.parquet(history).limit(0).write.parquet(empty)
    hidden = spark.read.parquet(stock).withColumn("statutDiffusionEtablissement", F.lit("P"))
    hidden.write.parquet(opted_out)
    runs = [
        (stock, history, [DEPARTEMENT]),
        (stock, history, ["98"]),
        (stock, empty, None),
        (opted_out, history, [DEPARTEMENT]),
    ]
    rows = []
    for number, (*paths, departements) in enumerate(runs, 1):
        build = run_build(spark, *paths, f"{root}/w", departements, as_of=AS_OF)
        versions = build.metrics.filter("metric = 'versions'").first()["value"]
        published = Warehouse(spark, f"{root}/w").read(FACT).count()
        rows.append((number, build.status, versions, published))
    return spark.createDataFrame(rows, "run int, status string, versions long, published long")


def stored_metrics(spark, sf):
    """Counts of a run, those of its versions observed while they were written."""
    root = _folder(spark)
    paths = _register(spark, sf, root)
    return run_build(spark, *paths, f"{root}/w", as_of=AS_OF).metrics


def stored_merge(spark, sf):
    """Two deliveries merged into a warehouse; the stock has gained and lost establishments."""
    number = F.col("siret").cast("long")
    stock, (first, second) = _stock(spark, sf), _deliveries(spark, sf)
    warehouse = Warehouse(spark, f"{_folder(spark)}/w")
    warehouse.create_schema()
    before, after = stock.filter(number % 7 != 0), stock.filter(number % 11 != 0)
    merge_month(warehouse, first.limit(0), first, before, as_of=AS_OF)
    merge_month(warehouse, first, second, after, as_of=AS_OF)
    return warehouse.read(FACT).drop("code_departement", "slot")


def stored_chunks(spark, sf):
    """The history loaded file by file."""
    root = _folder(spark)
    stock, history = _register(spark, sf, root, files=3)
    warehouse = load_chunks(spark, history, scan_stock(spark, stock), f"{root}/w", as_of=AS_OF)
    return warehouse.read(FACT).drop("slot")


def stored_balance(spark, sf):
    """A question per establishment on the stored fact, which is bucketed for it."""
    fact = _built(spark, sf, [None]).read(FACT)
    return analyses.net_balance(fact, FIRST_YEAR, LAST_YEAR)


def scan_retained(spark, sf):
    return joins.restrict_history(derived.history(spark, sf), _stock(spark, sf, [DEPARTEMENT]))


def date_window_a(spark, sf):
    bounds = Bounds(OLDEST_PLAUSIBLE, AS_OF)
    return filters.plausible_dates(
        derived.history(spark, sf), bounds, bounds, keep_null_end=False
    )


def date_window_b(spark, sf):
    bounds = Bounds(OLDEST_PLAUSIBLE, AS_OF, closed=True)
    return filters.plausible_dates(derived.history(spark, sf), bounds, keep_null_start=False)


def dim_tranche(spark, sf):
    """The reference bands with the number of establishments that carry each."""
    used = _stock(spark, sf).groupBy(F.col("tranche_effectifs").alias("code_tranche"))
    used = used.agg(F.count("*").alias("nb"))
    counted = headcount_bands(spark).join(used, "code_tranche", "left")
    nb = F.coalesce("nb", F.lit(0).cast("long")).alias("nb_etablissements")
    return counted.select("code_tranche", "libelle", nb)


def normalize_members(spark, sf):
    """Default members for missing, empty and malformed codes; some of the codes are made so here."""
    number = F.col("siret").cast("long")
    commune = F.when(number % 13 == 0, F.substring("code_commune", 1, 3))
    commune = commune.when(number % 17 == 0, "").otherwise(F.col("code_commune"))
    stock = normalize_stock(_stock(spark, sf).withColumn("code_commune", commune)).drop("code_ape")
    history = derived.history(spark, sf)
    for column, rest in (("code_ape", 5), ("etat", 7), ("nomenclature_ape", 9)):
        empty = F.when(F.col("seq") % 19 == rest, "").otherwise(F.col(column))
        history = history.withColumn(column, empty)
    return stock.join(normalize_history(history), "siret")


def insert_if_absent(spark, sf):
    """Versions of the first delivery, then those of the whole history on top of them."""
    stock, (first, second) = _stock(spark, sf), _months(spark, sf)
    existing = scd2_versions(first, stock)
    batch = scd2_versions(first.unionByName(second), stock)
    return existing.unionByName(absent_rows(existing, batch, PRIMARY_KEYS[FACT]))


def merged(spark, sf):
    stock, (first, second) = _stock(spark, sf), _months(spark, sf)
    return scd2_merge(scd2_versions(first, stock), first, second, stock)


def _deliveries(spark: SparkSession, sf: str, with_end: bool = False):
    """The history in two deliveries of which the second is about few establishments."""
    history = derived.history(spark, sf, with_end)
    late = (F.col("seq") % 50 == 0) & (F.col("siret").cast("long") % 5 == 0)
    return history.filter(~late), history.filter(late)


def merged_entrants(spark, sf):
    """A stock that has gained and lost establishments between the deliveries."""
    number = F.col("siret").cast("long")
    stock, (first, second) = _stock(spark, sf), _deliveries(spark, sf)
    before, after = stock.filter(number % 7 != 0), stock.filter(number % 11 != 0)
    return scd2_merge(scd2_versions(first, before), first, second, after)


def merged_departement(spark, sf):
    """Only one department is merged; the others keep the versions of the first delivery."""
    first, second = _deliveries(spark, sf)
    versions = scd2_versions(first, _stock(spark, sf))
    stock = _stock(spark, sf, [DEPARTEMENT])
    return scd2_merge(versions, first, second, stock, departements=[DEPARTEMENT])


def merged_as_of(spark, sf, rules):
    """A merge on a later day than the first load's, whose date bounds were narrower."""
    stock, (first, second) = _stock(spark, sf), _deliveries(spark, sf, with_end=True)
    before, now = preset(rules, EARLY), preset(rules, AS_OF)
    versions = scd2_versions(first, stock, **before)
    return scd2_merge(versions, first, second, stock, previous=before, **now)


def snapshot_moved(spark, sf):
    """Observed states with another commune and band for some establishments, none for others."""
    stock, (first, second) = _stock(spark, sf), _months(spark, sf)
    whole = scd2_versions(first.unionByName(second), stock).filter("is_current")
    number = F.col("siret").cast("long")
    moved = F.when(number % 3 == 0, "75001").otherwise(F.col("code_commune"))
    band = F.when(number % 4 == 0, "53").otherwise(F.col("code_tranche"))
    state = whole.filter(number % 5 != 0).withColumns({"code_commune": moved, "code_tranche": band})
    return scd2_snapshot(scd2_versions(first, stock), state, AS_OF)


def snapshot(spark, sf):
    """Versions of the first delivery, then every current state observed on one day."""
    stock, (first, second) = _stock(spark, sf), _months(spark, sf)
    whole = scd2_versions(first.unionByName(second), stock)
    return scd2_snapshot(scd2_versions(first, stock), whole.filter("is_current"), AS_OF)


def integrity_report(spark, sf):
    stock, history = _stock(spark, sf), derived.history(spark, sf, with_end=False)
    profile = dims.period_profile(joins.restrict_history(history, stock))
    return integrity.integrity_report(
        {
            "dim_commune": dims.dim_commune(stock),
            "dim_activite": dims.dim_activite(profile, AS_OF),
            "dim_date": dims.dim_date(profile),
            "dim_tranche_effectifs": headcount_bands(spark),
            FACT: scd2_versions(history, stock),
        }
    )


def integrity_seeded(spark, sf):
    """The report on tables that break every rule somewhere."""
    stock, history = _stock(spark, sf), derived.history(spark, sf, with_end=False)
    profile = dims.period_profile(joins.restrict_history(history, stock))
    number = F.col("siret").cast("long")

    def spoilt(column: str, rest: int, value) -> Column:
        return F.when(number % rest == 0, F.lit(value)).otherwise(F.col(column))

    fact = scd2_versions(history, stock)
    fact = fact.unionByName(fact.filter(number % 43 == 0)).withColumns(
        {
            "valid_from": spoilt("valid_from", 41, None).cast("date"),
            "is_current": spoilt("is_current", 31, None).cast("boolean"),
            "code_commune": spoilt("code_commune", 37, "00000"),
            "code_ape": spoilt("code_ape", 47, "ZZ.ZZ"),
        }
    )
    communes, code = dims.dim_commune(stock), F.col("code_commune")
    communes = communes.unionByName(communes.filter(code == COMMUNE)).withColumns(
        {
            "code_commune": F.when(code == "60000", "60000XX").otherwise(code),
            "libelle_commune": F.when(code != "61001", F.col("libelle_commune")),
        }
    )
    activities = dims.dim_activite(profile, AS_OF)
    named = F.when(F.col("code_ape") != "47.11F", F.col("nomenclature"))
    return integrity.integrity_report(
        {
            "dim_commune": communes,
            "dim_activite": activities.withColumn("nomenclature", named),
            "dim_date": dims.dim_date(profile).filter("annee <> 1995"),
            "dim_tranche_effectifs": headcount_bands(spark),
            FACT: fact,
        }
    )


def raw_key_report(spark, sf):
    """Periods that share their start date, before the versions are built."""
    raw = derived.history(spark, sf, with_end=False).withColumnRenamed("date_debut", "valid_from")
    return integrity.duplicate_keys(raw, FACT)


def run_metrics(spark, sf):
    stock, history = _stock(spark, sf), derived.history(spark, sf, with_end=False)
    retained = joins.restrict_history(history, stock)
    profile, fact = dims.period_profile(retained), scd2_versions(history, stock)
    return metrics(stock, profile, dims.dim_commune(stock), fact)


def q03(spark, sf):
    stock, history = _stock(spark, sf), derived.history(spark, sf, with_end=False)
    return analyses.top_communes(scd2_versions(history, stock), dims.dim_commune(stock))


def entry(spark: SparkSession) -> DataFrame:
    """Top sectors of the active establishments, from scan to top-k."""
    return analyses.top_sectors(_fact(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    def on_fact(question: Callable[..., DataFrame], *args) -> Query:
        return lambda spark, sf: question(_fact(spark, sf), *args)

    register: dict[str, Query] = {
        "scan_stock": lambda s, sf: _stock(s, sf, [DEPARTEMENT]),
        "scan_history": scan_retained,
        "filter_region": lambda s, sf: _stock(s, sf, REGION),
        "date_window_a": date_window_a,
        "date_window_b": date_window_b,
        "starts_before_1900": lambda s, sf: filters.starts_before(derived.history(s, sf)),
        "scd2_decided": _fact,
        "scd2_shipped_a": lambda s, sf: _fact(s, sf, "shipped_a"),
        "scd2_shipped_b": lambda s, sf: _fact(s, sf, "shipped_b"),
        "stock_history_left": lambda s, sf: joins.stock_with_history(
            _stock(s, sf), derived.history(s, sf)
        ),
        "sample_commune": lambda s, sf: joins.commune_sample(
            derived.stock(s, sf), derived.history(s, sf), COMMUNE
        ),
        "stg_periodes": lambda s, sf: staged_periods(_periods(s, sf)),
        "mart_dim_commune": lambda s, sf: dims.mart_dim_commune(staged_periods(_periods(s, sf))),
        "dim_activite": lambda s, sf: dims.dim_activite(_retained(s, sf, False), AS_OF),
        "dim_tranche": dim_tranche,
        "dim_commune": lambda s, sf: dims.dim_commune(_stock(s, sf)),
        "dim_date": lambda s, sf: dims.dim_date(_retained(s, sf, False)),
        "normalize_members": normalize_members,
        "insert_if_absent": insert_if_absent,
        "scd2_merge": merged,
        "scd2_merge_entrants": merged_entrants,
        "scd2_merge_departement": merged_departement,
        "scd2_merge_as_of_a": lambda s, sf: merged_as_of(s, sf, "shipped_a"),
        "scd2_merge_as_of_b": lambda s, sf: merged_as_of(s, sf, "shipped_b"),
        "scd2_snapshot": snapshot,
        "scd2_snapshot_moved": snapshot_moved,
        "quality_bounds": lambda s, sf: quality.date_bounds(_retained(s, sf)),
        "quality_anomalies": lambda s, sf: quality.date_anomalies(_retained(s, sf), AS_OF),
        "quality_report": lambda s, sf: quality.quality_report(_retained(s, sf), AS_OF),
        "integrity_report": integrity_report,
        "integrity_seeded": integrity_seeded,
        "raw_key_report": raw_key_report,
        "dup_check": lambda s, sf: integrity.distinct_check(
            dims.dim_commune(_stock(s, sf)), "code_commune"
        ),
        "run_metrics": run_metrics,
        "stored_scan": stored_scan,
        "stored_models": stored_models,
        "stored_fact": stored_fact,
        "stored_departements": stored_departements,
        "stored_dims": stored_dims,
        "stored_guard": stored_guard,
        "stored_metrics": stored_metrics,
        "stored_merge": stored_merge,
        "stored_chunks": stored_chunks,
        "stored_balance": stored_balance,
        "count_prefix": on_fact(filters.count_prefix, "code_commune", DEPARTEMENT),
        "as_of": on_fact(filters.as_of, PAST),
        "q01_active": on_fact(analyses.active_now),
        "q02_top_sectors": on_fact(analyses.top_sectors),
        "q03_top_communes": q03,
        "q04_by_band": lambda s, sf: analyses.active_by_band(_fact(s, sf), headcount_bands(s)),
        "q05_jobs": on_fact(analyses.jobs_estimate),
        "q06_active_past": on_fact(analyses.active_on, PAST),
        "q07_sector_growth": on_fact(analyses.sector_growth, PAST),
        "q08_entity": on_fact(analyses.entity_history, SIRET),
        "q09_creations": on_fact(analyses.creations_per_year, FIRST_YEAR, LAST_YEAR),
        "q10_closures": on_fact(analyses.closures_per_year, FIRST_YEAR, LAST_YEAR),
        "q11_net_balance": on_fact(analyses.net_balance, FIRST_YEAR, LAST_YEAR),
    }
    corpus = dict(LLM.QUERIES) if LLM else {}
    if PIPELINE:
        corpus["pipeline"] = PIPELINE.run
    return register | corpus


def oracle_sql() -> dict[str, str]:
    twins = dict(ORACLE)
    if LLM:
        twins |= LLM.ORACLE
    if PIPELINE and PIPELINE.ORACLE_SQL:
        twins["pipeline"] = PIPELINE.ORACLE_SQL
    return twins
