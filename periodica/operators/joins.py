"""Joins of the stock with the history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.operators.filters import diffusible, in_commune


def restrict_history(history: DataFrame, stock: DataFrame) -> DataFrame:
    """Periods of the retained establishments. The join has no hint: run-time sizes decide whether
    the keys are sent to every executor, and a crowded establishment is split."""
    return history.join(stock.select("siret"), "siret", "left_semi")


def stock_with_history(stock: DataFrame, history: DataFrame) -> DataFrame:
    """Left outer join: every establishment with its periods, or one row without a period.

    The periods of one establishment are the side that may be crowded, and an outer join cannot
    split its optional side. An inner join can, and the establishments without a period are found
    on the distinct keys of the history.
    """
    stock = stock.drop("code_ape")
    matched = stock.join(history, "siret")
    without = stock.join(history.select("siret").distinct(), "siret", "left_anti")
    return matched.unionByName(without, allowMissingColumns=True)


def commune_sample(stock: DataFrame, history: DataFrame, commune: str) -> DataFrame:
    """Periods of one commune with the current stock attributes, in the published layout."""
    kept = in_commune(diffusible(stock), commune).select(
        "siret",
        "code_commune",
        "libelle_commune",
        F.col("tranche_effectifs").alias("code_tranche"),
    )
    return periods_with_stock(kept, history)


def periods_with_stock(stock: DataFrame, history: DataFrame) -> DataFrame:
    """History joined with stock attributes, columns named and ordered as the `periodes` source."""
    return history.join(stock, "siret").select(
        "siret",
        F.col("date_debut").alias("dateDebut"),
        F.col("date_fin").alias("dateFin"),
        "etat",
        "code_ape",
        "code_commune",
        "libelle_commune",
        "code_tranche",
    )
