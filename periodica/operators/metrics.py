"""Run metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.functions.territory import in_departements


def _metrics(df: DataFrame, **counts) -> DataFrame:
    """One pass over `df`, one row per named count."""
    totals = df.agg(*[test.alias(name) for name, test in counts.items()])
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in counts]
    return totals.select(F.inline(F.array(*pairs)))


def _total(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0).cast("long"))


def fact_counts(departements=None, place: str = "code_departement") -> dict[str, Column]:
    """Counts of versions, to aggregate or to observe while they are written."""
    inside = F.lit(True) if departements is None else in_departements(place, departements)
    return {
        "versions": F.count_if(inside),
        "versions_courantes": F.count_if(inside & F.col("is_current")),
    }


def metric_rows(observed: dict[str, int]) -> list[tuple[str, int]]:
    return [(name, observed[name]) for name in fact_counts()]


def run_metrics(
    stock: DataFrame,
    periods: DataFrame,
    dim_commune: DataFrame,
    fact: DataFrame | None,
    departements=None,
) -> DataFrame:
    """Rows (`metric`, `value`): establishments, periods, communes and versions of the run.

    `periods` is a `dims.period_profile`. Without a `fact` its counts are left out; a build observes
    them while it writes (`fact_counts`) and has no reason to read it again.
    """
    if departements is not None:
        dim_commune = dim_commune.filter(in_departements("code_commune", departements))
    parts = [
        _metrics(stock, siret_stock=F.count("*")),
        _metrics(
            periods,
            periodes=_total(F.col("nb")),
            periodes_sans_debut=_total(F.when(F.col("date_debut").isNull(), F.col("nb"))),
        ),
        _metrics(dim_commune, communes=F.count("*")),
    ]
    if fact is not None:
        # a stored fact is partitioned by department: only these directories are read
        place = "code_departement" if "code_departement" in fact.columns else "code_commune"
        if departements is not None:
            fact = fact.filter(in_departements(place, departements))
        parts.append(_metrics(fact, **fact_counts()))
    return reduce(DataFrame.unionByName, parts)
