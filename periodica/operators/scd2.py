"""Type-2 versions from validity periods.

Plan: two shuffles of the history, whatever the number of rows of one establishment.

1. One row per (siret, start date). Crowded keys are cut inside the map tasks, see `first_per_key`.
   After this an establishment has at most one row per calendar day, which bounds the windows below.
   A source known to have unique starts needs no such step, and a single shuffle.
2. Shuffle on siret, one sort; `lag` finds the run starts, `lead` closes each run. Joining the stock
   on siret keeps that partitioning and order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from periodica.functions.dates import OLDEST_PLAUSIBLE, Bounds, exclusive_end
from periodica.functions.members import UNKNOWN, normalize_history, normalize_stock
from periodica.functions.territory import in_departements
from periodica.operators.filters import plausible_dates, plausible_test
from periodica.operators.keys import first_per_key
from periodica.schemas import FAIT

# Values of a period in the fact; a version opens when one of them changes.
ATTRIBUTES = ("code_ape", "etat")
END_MODES = ("next_version", "first_period_end", "first_period_end_plus_1")
CURRENT_MODES = ("last_version", "open_period")


def preset(name: str, as_of: dt.date) -> dict:
    """Keyword arguments of `scd2_versions` for the decided rules or one of the shipped loaders."""
    if name == "decided":
        return {}
    if name == "shipped_a":
        bounds = Bounds(OLDEST_PLAUSIBLE, as_of)
        return {
            "start_bounds": bounds,
            "end_bounds": bounds,
            "keep_null_end": False,
            "end_mode": "first_period_end",
        }
    if name == "shipped_b":
        return {
            "start_bounds": Bounds(OLDEST_PLAUSIBLE, as_of, closed=True),
            "end_mode": "first_period_end_plus_1",
            "current_mode": "open_period",
            "default_members": True,
        }
    raise ValueError(f"unknown preset {name!r}")


def _state(tracked: Sequence[str]) -> Column:
    """Tracked columns compared one by one; NULL is the same as the unknown member."""
    return F.struct(*[F.coalesce(c, F.lit(UNKNOWN)).alias(c) for c in tracked])


def collapse_runs(periods: DataFrame, start: str, tracked: Sequence[str]) -> DataFrame:
    """First period of each run of equal tracked values, with the next run's start in `next_start`.

    Expects one row per (siret, start).
    """
    by_siret = W.partitionBy("siret").orderBy(start)
    state = _state(tracked)
    changed = ~F.lag(state).over(by_siret).eqNullSafe(state)
    runs = periods.withColumn("_changed", changed).filter("_changed").drop("_changed")
    return runs.withColumn("next_start", F.lead(start).over(by_siret))


def dated_periods(
    history: DataFrame,
    start: str = "date_debut",
    values: Sequence[str] = ATTRIBUTES,
    tie_break: Sequence[str] = (),
    unique_starts: bool = False,
) -> DataFrame:
    """One period per (siret, start) with its values; the tie-break columns choose it, then the
    values. NULL starts are left out, `quality.undated_periods` lists them."""
    dated = history.filter(F.col(start).isNotNull() & F.col("siret").isNotNull())
    columns = ["siret", start, *values]
    if unique_starts:
        return dated.select(*columns)
    order = [c for c in tie_break if c not in columns]
    kept = dated.select(*columns, *order)
    ranked = [F.asc_nulls_last(c) for c in (*tie_break, *values)]
    return first_per_key(kept, ["siret", start], ranked).drop(*order)


def scd2_versions(
    history: DataFrame,
    stock: DataFrame,
    *,
    key: str = "siret",
    start: str = "date_debut",
    end: str = "date_fin",
    tracked: Sequence[str] = ATTRIBUTES,
    tie_break: Sequence[str] | None = None,
    start_bounds: Bounds | None = None,
    end_bounds: Bounds | None = None,
    keep_null_end: bool = True,
    end_mode: str = "next_version",
    current_mode: str = "last_version",
    default_members: bool = False,
    unique_starts: bool = False,
) -> DataFrame:
    """Version fact: a new version opens when a tracked column changes within an establishment.

    `stock` gives the current commune and band of the retained establishments; other establishments
    drop out. `tie_break` orders periods with the same start (`seq` where the history has it).
    `unique_starts` promises that no two periods of an establishment start on the same day; step 1
    and its shuffle are then left out. `integrity.duplicate_keys` checks the promise.
    """
    if end_mode not in END_MODES or current_mode not in CURRENT_MODES:
        raise ValueError(f"unknown mode {end_mode!r} / {current_mode!r}")
    history = history.withColumnsRenamed({key: "siret", start: "date_debut", end: "date_fin"})
    stock = stock.withColumnRenamed(key, "siret")
    if tie_break is None:
        tie_break = ("seq",) if "seq" in history.columns else ()
    if default_members:
        history, stock = normalize_history(history), normalize_stock(stock)
    kept = plausible_dates(history, start_bounds, end_bounds, keep_null_end=keep_null_end)

    values = list(dict.fromkeys([*tracked, *ATTRIBUTES]))
    if end_mode != "next_version" or current_mode == "open_period":
        values.append("date_fin")
    periods = dated_periods(kept, "date_debut", values, tie_break, unique_starts)
    runs = collapse_runs(periods, "date_debut", tracked)

    if end_mode == "next_version":
        valid_to = F.col("next_start")
    elif end_mode == "first_period_end":
        valid_to = F.col("date_fin")
    else:
        valid_to = exclusive_end("date_fin")
    current = F.col("next_start") if current_mode == "last_version" else F.col("date_fin")

    versions = runs.select(
        "siret",
        F.col("date_debut").alias("valid_from"),
        valid_to.alias("valid_to"),
        current.isNull().alias("is_current"),
        *ATTRIBUTES,
    )
    return with_stock(versions, stock)


def with_stock(versions: DataFrame, stock: DataFrame) -> DataFrame:
    """Versions of the retained establishments with their current commune and band."""
    attributes = stock.select(
        "siret", "code_commune", F.col("tranche_effectifs").alias("code_tranche")
    )
    joined = versions.drop("code_commune", "code_tranche").join(attributes, "siret")
    return joined.select(*[f.name for f in FAIT.fields])


def window_moved(periods: DataFrame, before: dict, now: dict) -> DataFrame:
    """Periods that only one of two sets of date rules keeps."""

    def kept(rules: dict) -> Column:
        return plausible_test(
            rules.get("start_bounds"),
            rules.get("end_bounds"),
            keep_null_end=rules.get("keep_null_end", True),
            start=rules.get("start", "date_debut"),
            end=rules.get("end", "date_fin"),
        )

    return periods.filter(~kept(before).eqNullSafe(kept(now)))


def scd2_merge(
    versions: DataFrame,
    loaded: DataFrame,
    batch: DataFrame,
    stock: DataFrame,
    *,
    departements: Sequence[str] | None = None,
    previous: dict | None = None,
    touched: DataFrame | None = None,
    **rules,
) -> DataFrame:
    """Fact after new periods: equal to `scd2_versions` over `loaded` and `batch` together.

    `loaded` are the periods of all establishments so far, in scope or not. Versioned again, from all
    their periods, are the establishments with a new period, those that the stock has gained, and,
    if `previous` (the rules of the last run) had other date bounds, those with a period that only
    one of the two admits. The others keep their versions. All take the commune and band of `stock`,
    and establishments no longer in it drop out.

    A caller who knows those that are versioned again gives them as `touched`, one row each.

    With `departements`, `stock` is that of these departments only: versions elsewhere stay as they
    are, but for those of establishments that have moved into one of the departments.
    """
    key = rules.get("key", "siret")
    if rules.get("default_members"):
        stock = normalize_stock(stock)
    known = stock.withColumnRenamed(key, "siret")
    periods = loaded.unionByName(batch, allowMissingColumns=True)

    if touched is None:
        entrants = known.select("siret").join(versions.select("siret"), "siret", "left_anti")
        touched = batch.select(F.col(key).alias("siret")).union(entrants)
        if previous is not None:
            moved = window_moved(loaded, previous, rules)
            touched = touched.union(moved.select(F.col(key).alias("siret")))
        touched = touched.distinct()

    kept = with_stock(versions.join(touched, "siret", "left_anti"), known)
    again = periods.join(touched.withColumnRenamed("siret", key), key, "left_semi")
    merged = kept.unionByName(scd2_versions(again, stock, **rules))
    if departements is None:
        return merged
    inside = F.coalesce(in_departements("code_commune", departements), F.lit(False))
    elsewhere = versions.filter(~inside).join(known.select("siret"), "siret", "left_anti")
    return elsewhere.select(merged.columns).unionByName(merged)


def scd2_snapshot(versions: DataFrame, state: DataFrame, at: dt.date) -> DataFrame:
    """Fact after observing `state` (siret, code_ape, etat, code_commune, code_tranche) on `at`.

    A changed establishment gets its version closed at `at` and a new one opened, an unchanged one
    keeps its versions, a new one is opened. Commune and band are current values: the observed ones
    are spread over all versions of the establishment. An unobserved establishment passes through
    untouched. Of several observations of an establishment the least in its values counts.

    Versions ended by `at` cannot change; the version in force and any that start later are taken
    together with the observation. A version that already starts on `at` wins over it. Versions end
    where the next one starts (the decided rules).
    """
    values = [*ATTRIBUTES, "code_commune", "code_tranche"]
    state = first_per_key(
        state.select("siret", *values), ["siret"], [F.asc_nulls_last(c) for c in values]
    )
    columns = [f.name for f in FAIT.fields]
    observed = state.withColumns({"valid_from": F.lit(at), "observed": F.lit(True)})
    rows = versions.select(*columns, F.lit(False).alias("observed"))
    rows = rows.unionByName(observed, allowMissingColumns=True)
    # one shuffle and one sort serve all windows
    rows = rows.withColumn("live", F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(at)))
    all_rows = W.partitionBy("siret").orderBy("live", "valid_from", "observed")
    all_rows = all_rows.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    chain = W.partitionBy("siret", "live").orderBy("valid_from", "observed")
    seen = F.when(F.col("observed"), F.struct("code_commune", "code_tranche"))
    rows = rows.withColumns(
        {
            "seen": F.max(seen).over(all_rows),
            "again": F.lag("valid_from").over(chain).eqNullSafe(F.col("valid_from")),
        }
    )
    open_chain = F.col("live") & F.col("seen").isNotNull()
    rows = rows.filter(~(open_chain & F.col("again")))
    state_of = _state(ATTRIBUTES)
    changed = ~F.lag(state_of).over(chain).eqNullSafe(state_of)
    rows = rows.withColumn("changed", changed).filter(~open_chain | F.col("changed"))
    rows = rows.withColumn("next_start", F.lead("valid_from").over(chain))
    current = {
        c: F.when(F.col("seen").isNotNull(), F.col("seen")[c]).otherwise(F.col(c))
        for c in ("code_commune", "code_tranche")
    }
    return rows.withColumns(
        {
            "valid_to": F.when(open_chain, F.col("next_start")).otherwise(F.col("valid_to")),
            "is_current": F.when(open_chain, F.col("next_start").isNull()).otherwise(
                F.col("is_current")
            ),
            **current,
        }
    ).select(columns)
