"""Dimensions of the star schema.

Each first reduces the input to distinct small rows, which Spark does inside the map tasks, and only
then picks one row per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.functions.dates import as_date, date_parts, today
from periodica.functions.territory import departement_of
from periodica.operators.keys import first_per_key


def period_profile(history: DataFrame) -> DataFrame:
    """Number of periods (`nb`) per activity, nomenclature and start date.

    Enough for the activity and date dimensions and for the period counts of a run, and small: one
    pass over the history serves them all.
    """
    return history.groupBy("code_ape", "nomenclature_ape", "date_debut").agg(
        F.count("*").alias("nb")
    )


def dim_activite(history: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """One nomenclature per activity code: the one seen last up to `as_of`, then the greatest."""
    seen = F.when(F.col("date_debut") <= today(as_of), F.col("date_debut"))
    pairs = (
        history.filter(F.col("code_ape").isNotNull())
        .groupBy("code_ape", F.col("nomenclature_ape").alias("nomenclature"))
        .agg(F.max(seen).alias("last_seen"))
    )
    order = [
        F.col("nomenclature").isNull(),
        F.desc_nulls_last("last_seen"),
        F.desc("nomenclature"),
    ]
    return first_per_key(pairs, ["code_ape"], order).select("code_ape", "nomenclature")


def dim_commune(stock: DataFrame, overseas: bool = True) -> DataFrame:
    """One label per commune, the least; NULL only where the commune has no other. The department is
    the fact's: three characters overseas."""
    return mart_dim_commune(stock).withColumn(
        "code_departement", departement_of("code_commune", overseas)
    )


def mart_dim_commune(periods: DataFrame) -> DataFrame:
    """Any label per commune; the least, so that the answer is always the same."""
    pairs = periods.select("code_commune", "libelle_commune").distinct()
    return pairs.groupBy("code_commune").agg(F.min("libelle_commune").alias("libelle_commune"))


def dim_date(history: DataFrame, column: str = "date_debut") -> DataFrame:
    """Distinct start dates with year, quarter and month; text that is no date is left out."""
    dates = history.select(as_date(column).alias("date_id")).distinct()
    return dates.filter(F.col("date_id").isNotNull()).select("date_id", *date_parts("date_id"))
