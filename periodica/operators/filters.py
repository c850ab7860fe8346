"""Row filters of the register."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.functions.dates import OLDEST_PLAUSIBLE, Bounds, valid_at
from periodica.functions.territory import in_departements

DISTRIBUTABLE = "O"


def diffusible(stock: DataFrame, status: str = "statut_diffusion") -> DataFrame:
    """Privacy rule: only establishments that may be published in full."""
    return stock.filter(F.col(status) == DISTRIBUTABLE)


def in_territory(
    df: DataFrame, departements: Iterable[str], code: str = "code_commune"
) -> DataFrame:
    return df.filter(in_departements(code, departements))


def in_commune(df: DataFrame, commune: str, code: str = "code_commune") -> DataFrame:
    return df.filter(F.col(code) == commune)


def _within(column: str, bounds: Bounds | None, keep_null: bool) -> Column:
    date = F.col(column)
    test = F.lit(True) if bounds is None else bounds.contains(date)
    return test | date.isNull() if keep_null else test & date.isNotNull()


def plausible_test(
    start_bounds: Bounds | None = None,
    end_bounds: Bounds | None = None,
    *,
    keep_null_start: bool = True,
    keep_null_end: bool = True,
    start: str = "date_debut",
    end: str = "date_fin",
) -> Column:
    """Whether both dates lie in the bounds; without bounds only the NULL policy applies."""
    test = F.lit(True)
    if start_bounds is not None or not keep_null_start:
        test = _within(start, start_bounds, keep_null_start)
    if end_bounds is not None or not keep_null_end:
        test = test & _within(end, end_bounds, keep_null_end)
    return test


def plausible_dates(
    history: DataFrame,
    start_bounds: Bounds | None = None,
    end_bounds: Bounds | None = None,
    **policy,
) -> DataFrame:
    """Rows that pass `plausible_test`."""
    return history.filter(plausible_test(start_bounds, end_bounds, **policy))


def starts_before(
    history: DataFrame, day: dt.date = OLDEST_PLAUSIBLE, start: str = "date_debut"
) -> DataFrame:
    return history.filter(F.col(start) < F.lit(day))


def current_active(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("is_current") & (F.col("etat") == "A"))


def active_at(fact: DataFrame, day: dt.date) -> DataFrame:
    return fact.filter((F.col("etat") == "A") & valid_at(day))


def as_of(fact: DataFrame, day: dt.date) -> DataFrame:
    """Versions in force on a day."""
    return fact.filter(valid_at(day))


def closing(previous: str = "etat_precedent", state: str = "etat") -> Column:
    """Transition from active to closed."""
    return (F.col(state) == "F") & (F.col(previous) == "A")


def count_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """One row `nb`: rows whose text column starts with the prefix."""
    return df.filter(F.col(column).startswith(prefix)).agg(F.count("*").alias("nb"))
