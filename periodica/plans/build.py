"""Build of the warehouse from the two register files, and the monthly merge."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.functions.members import UNKNOWN_COMMUNE, normalize_history, normalize_stock
from periodica.functions.territory import departement_argument, in_departements
from periodica.operators.dims import dim_activite, dim_commune, dim_date, period_profile
from periodica.operators.integrity import IntegrityError, duplicate_keys, integrity_report
from periodica.operators.joins import restrict_history
from periodica.operators.metrics import fact_counts, metric_rows, run_metrics
from periodica.operators.scd2 import preset, scd2_merge, scd2_versions, window_moved
from periodica.plans.warehouse import FACT, Part, Warehouse, slot_of, with_departement
from periodica.sources.register import headcount_bands, scan_history, scan_stock

#: What a run did: versions published, only old ones taken away, nothing to load.
LOADED, WITHDRAWN, NOTHING = "loaded", "withdrawn", "nothing"


class Build(NamedTuple):
    status: str
    metrics: DataFrame


def build_warehouse(
    spark: SparkSession,
    stock_path: str,
    history_path: str,
    root: str,
    departements: Iterable[str] | None = None,
    **options,
) -> DataFrame:
    """The metrics of `run_build`."""
    return run_build(spark, stock_path, history_path, root, departements, **options).metrics


def run_build(
    spark: SparkSession,
    stock_path: str,
    history_path: str,
    root: str,
    departements: Iterable[str] | None = None,
    *,
    rules: str = "decided",
    as_of: dt.date | None = None,
    unique_starts: bool = False,
    fail_on_violation: bool = False,
) -> Build:
    """Scan, filter, versions, dimensions, publish; returns the status and the run metrics.

    The versions are written first, unseen, and counted as they are written. Without any the run
    adds nothing; it only takes away what its departments no longer retain. Otherwise the dimensions
    gain their rows and one line makes the versions visible: those of the run's departments replace
    the old ones, other departments keep theirs, so a region is one run or several. A run that breaks
    off before that line leaves every reader on the old state.
    `unique_starts`: see `scd2_versions`; for a source whose key is (siret, start).
    `fail_on_violation` checks keys and references before the versions are published.
    """
    as_of = as_of or dt.date.today()
    departements = None if departements is None else list(departements)
    stock = scan_stock(spark, stock_path, departements)
    history = scan_history(spark, history_path)

    options = preset(rules, as_of)
    warehouse = Warehouse(spark, root)
    warehouse.create_schema()
    warehouse.insert("dim_tranche_effectifs", headcount_bands(spark))
    # the filtered stock and the counts serve several steps
    stock = stock.persist()
    retained = restrict_history(history, stock)
    profile = period_profile(retained).persist()
    try:
        if unique_starts:
            _check_unique_starts(retained)
        fact = scd2_versions(retained, stock, unique_starts=unique_starts, **options)
        fact = fact.withColumn("loaded", F.lit(True))
        replaced = _everything
        if departements is not None:
            others, replaced = _others(warehouse, stock, departements, options)
            fact = fact.unionByName(others.withColumn("loaded", F.lit(False)))
        counts = {"loaded": F.count_if("loaded"), **fact_counts(departements)}
        staged = warehouse.stage(FACT, fact, **counts)
        status = LOADED
        if staged.counts["loaded"] == 0:
            old = [part for part in warehouse.state(FACT).parts if replaced(part)]
            status = WITHDRAWN if departements is not None and old else NOTHING
        if status == NOTHING:
            staged.discard()
        else:
            _insert_dims(warehouse, stock, profile, options, as_of)
            staged.publish(replaced, _strict(warehouse) if fail_on_violation else None)
            warehouse.note_load(rules, as_of)

        communes = warehouse.read("dim_commune")
        metrics = run_metrics(stock, profile, communes, None, departements).collect()
        rows = [tuple(row) for row in metrics] + metric_rows(staged.counts)
        return Build(status, spark.createDataFrame(rows, "metric string, value long"))
    finally:
        profile.unpersist()
        stock.unpersist()


def _everything(part: Part) -> bool:
    return True


def _others(
    warehouse: Warehouse, stock: DataFrame, departements: list[str], options: dict
) -> tuple[DataFrame, Callable[[Part], bool]]:
    """What a run of some departments writes again beside its own versions, and which parts go.

    All parts of the departments go, so nobody stays who is no longer retained. So do parts elsewhere
    that hold an establishment which has moved into the departments, and those of the unknown
    commune, which belongs to no single run; their other versions are written again.
    """
    retained = stock.select("siret")
    outside = warehouse.read(FACT).filter(~_inside(departements))
    moved = outside.join(retained, "siret", "left_semi")
    # at most one row for each part
    places = {tuple(row) for row in moved.select("code_departement", "slot").distinct().collect()}
    prefixes = tuple(departement_argument(d) for d in departements)
    unknown = UNKNOWN_COMMUNE[:2] if options.get("default_members") else None

    def replaced(part: Part) -> bool:
        code = part.departement
        if code is not None and code.startswith(prefixes):
            return True
        return (code, part.slot) in places or (unknown is not None and code == unknown)

    parts = [part for part in warehouse.state(FACT).parts if replaced(part)]
    others = outside.filter(_at(parts)).join(retained, "siret", "left_anti")
    return others.drop("code_departement", "slot"), replaced


def _at(parts: Iterable[tuple]) -> Column:
    """Rows of the stored fact in one of the places; a test of its partition columns alone."""
    names = [f"{part[0] or ''}/{part[1]}" for part in parts]
    place = F.concat_ws("/", F.coalesce("code_departement", F.lit("")), F.col("slot").cast("string"))
    return place.isin(names) if names else F.lit(False)


def _check_unique_starts(periods: DataFrame) -> None:
    """Raise if the promise behind `unique_starts` is broken."""
    dated = periods.filter(F.col("date_debut").isNotNull())
    repeated = duplicate_keys(dated.withColumnRenamed("date_debut", "valid_from"), FACT)
    found = repeated.limit(5).collect()
    if found:
        raise IntegrityError("starts are not unique: " + "; ".join(row["key"] for row in found))


def _insert_dims(
    warehouse: Warehouse, stock: DataFrame, profile: DataFrame, options: dict, as_of: dt.date
) -> None:
    if options.get("default_members"):
        stock, profile = normalize_stock(stock), normalize_history(profile)
    warehouse.insert("dim_activite", dim_activite(profile, as_of))
    warehouse.insert("dim_commune", dim_commune(stock))
    warehouse.insert("dim_date", dim_date(profile))


def _strict(warehouse: Warehouse) -> Callable[[DataFrame], None]:
    def verify(fact: DataFrame) -> None:
        integrity_report({**warehouse.tables(), FACT: fact}, fail_on_violation=True)

    return verify


def _inside(departements: list[str]) -> Column:
    """Stored versions of the departments: a test of the partition column."""
    return F.coalesce(in_departements("code_departement", departements), F.lit(False))


def _changed(
    warehouse: Warehouse,
    loaded: DataFrame,
    batch: DataFrame,
    known: DataFrame,
    departements: list[str] | None,
    previous: dict | None,
    options: dict,
    same_stock: bool,
) -> DataFrame:
    """Establishments whose versions a merge changes; one row each. `again`: their periods are
    versioned again; `retained`: they are in the stock."""
    again, retained = F.lit(True).alias("again"), F.lit(True).alias("retained")
    same, gone = F.lit(False).alias("again"), F.lit(False).alias("retained")
    inside = known.select("siret")
    changed = batch.select("siret", again, retained).join(inside, "siret", "left_semi")
    if previous is not None and _bounds(previous) != _bounds(options):
        moved = window_moved(loaded, previous, options).select("siret", again, retained)
        changed = changed.union(moved.join(inside, "siret", "left_semi"))
    if not same_stock:
        fact = warehouse.read(FACT)
        # read bucket by bucket, so without a shuffle
        attributes = fact.groupBy("siret").agg(
            F.first("code_commune").alias("old_commune"), F.first("code_tranche").alias("old_band")
        )
        entrants = inside.join(attributes, "siret", "left_anti")
        dated = loaded.filter(F.col("date_debut").isNotNull()).select("siret", again, retained)
        changed = changed.union(dated.join(entrants, "siret", "left_semi"))
        equal = F.col("old_commune").eqNullSafe(F.col("code_commune"))
        equal &= F.col("old_band").eqNullSafe(F.col("tranche_effectifs"))
        other = known.join(attributes, "siret").filter(~equal)
        changed = changed.union(other.select("siret", same, retained))
        scope = fact if departements is None else fact.filter(_inside(departements))
        left = scope.select("siret").join(inside, "siret", "left_anti")
        changed = changed.union(left.select("siret", same, gone))
    return changed.groupBy("siret").agg(F.max("again").alias("again"), F.max("retained").alias("retained"))


def _bounds(rules: dict) -> tuple:
    return tuple(rules.get(name) for name in ("start_bounds", "end_bounds", "keep_null_end"))


def merge_month(
    warehouse: Warehouse,
    loaded: DataFrame,
    batch: DataFrame,
    stock: DataFrame,
    *,
    departements: Iterable[str] | None = None,
    rules: str = "decided",
    as_of: dt.date | None = None,
    same_stock: bool = False,
) -> int:
    """Bring new periods into a published warehouse; returns the number of versions written.

    `loaded` are all periods so far, of all establishments: those that the stock has gained, or whose
    dates the new `as_of` admits, are versioned from them too. The dimensions gain their rows as
    well. The rules must be those of the last load.

    Only the parts of the fact are written again that hold an establishment whose versions change, or
    will hold one; all others stay as they are. `same_stock` promises that the stock is that of the
    last load, so that only the batch and the dates decide; then the keys of the fact aren't read.
    """
    as_of = as_of or dt.date.today()
    departements = None if departements is None else list(departements)
    last = warehouse.last_load()
    if last is not None and last[0] != rules:
        raise ValueError(f"the warehouse was loaded under the rules {last[0]!r}")
    options = preset(rules, as_of)
    previous = None if last is None else preset(rules, last[1])
    known = normalize_stock(stock) if options.get("default_members") else stock
    known = with_departement(known).withColumn("slot", slot_of("siret", warehouse.buckets)).persist()

    changed = _changed(
        warehouse, loaded, batch, known, departements, previous, options, same_stock
    ).persist()
    ours = changed.filter("retained").select("siret")
    # the periods of the changed establishments serve the versions and the dimensions
    whole = loaded.unionByName(batch, allowMissingColumns=True).join(ours, "siret", "left_semi").persist()
    profile = period_profile(whole).persist()
    try:
        fact = warehouse.read(FACT)
        places = [
            df.join(changed, "siret", "left_semi").select("code_departement", "slot")
            for df in (fact, known)
        ]
        # at most one row for each part, old or new
        parts = {tuple(row) for row in places[0].union(places[1]).distinct().collect()}
        mine = known.filter(_at(parts)).drop("code_departement", "slot")
        merged = scd2_merge(
            fact.filter(_at(parts)).drop("code_departement", "slot"), whole, whole.limit(0), mine,
            departements=departements, touched=changed.filter("again").select("siret"), **options,
        )
        staged = warehouse.stage(FACT, merged) if parts else None
        _insert_dims(warehouse, stock, profile, options, as_of)
    finally:
        for cached in (profile, whole, changed, known):
            cached.unpersist()
    if staged is not None:
        staged.publish(lambda part: part[:2] in parts)
    warehouse.note_load(rules, as_of)
    return 0 if staged is None else staged.counts["rows"]
