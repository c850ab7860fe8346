"""Quality of the dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.functions.dates import OLDEST_PLAUSIBLE, today


def _bounds() -> list:
    return [
        F.min("date_debut").alias("debut_min"),
        F.max("date_debut").alias("debut_max"),
        F.min("date_fin").alias("fin_min"),
        F.max("date_fin").alias("fin_max"),
        F.count("*").alias("total_lignes"),
    ]


def _anomalies(as_of: dt.date | None) -> list:
    start, end, now = F.col("date_debut"), F.col("date_fin"), today(as_of)
    return [
        F.count_if(start < F.lit(OLDEST_PLAUSIBLE)).alias("debut_trop_vieux"),
        F.count_if(start > now).alias("debut_futur"),
        F.count_if(end > now).alias("fin_futur"),
        F.count_if(end < start).alias("fin_avant_debut"),
    ]


def date_bounds(history: DataFrame) -> DataFrame:
    return history.agg(*_bounds())


def date_anomalies(history: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return history.agg(*_anomalies(as_of))


def quality_report(history: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Bounds and anomaly counts in one pass, one row."""
    return history.agg(*_bounds(), *_anomalies(as_of))


def undated_periods(history: DataFrame) -> DataFrame:
    """Periods without a start: they cannot be versions, the key needs the date."""
    return history.filter(F.col("date_debut").isNull())
