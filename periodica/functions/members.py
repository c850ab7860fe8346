"""Headcount bands and the default members for unknown codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The official headcount bands, code -> label.
BANDS = {
    "NN": "non renseigné",
    "00": "0 salarié",
    "01": "1-2",
    "02": "3-5",
    "03": "6-9",
    "11": "10-19",
    "12": "20-49",
    "21": "50-99",
    "22": "100-199",
    "31": "200-249",
    "32": "250-499",
    "41": "500-999",
    "42": "1000-1999",
    "51": "2000-4999",
    "52": "5000-9999",
    "53": "10000+",
}
# Estimated jobs per band; every other code counts 0.
MIDPOINTS = {
    "00": 0,
    "01": 1.5,
    "02": 4,
    "03": 7.5,
    "11": 15,
    "12": 35,
    "21": 75,
    "22": 150,
    "31": 225,
    "32": 375,
    "41": 750,
    "42": 1500,
    "51": 3500,
    "52": 7500,
    "53": 12000,
}
UNKNOWN = "?"
UNKNOWN_COMMUNE = "99999"
UNKNOWN_BAND = "NN"


def or_unknown(column: Column | str) -> Column:
    """`?` for NULL or empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.nullif(column, F.lit("")), F.lit(UNKNOWN))


def known_commune(column: Column | str) -> Column:
    """`99999` for NULL and for a code that has not five characters."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(F.length(column) == 5, column).otherwise(UNKNOWN_COMMUNE)


def known_band(column: Column | str) -> Column:
    """`NN` for NULL and for a code outside the sixteen bands."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column.isin(*BANDS), column).otherwise(UNKNOWN_BAND)


def estimated_jobs(band: str) -> Column:
    """Midpoint of the band in a column, 0 for unknown, missing and `NN`."""
    cases = " ".join(f"WHEN '{code}' THEN {float(jobs)}D" for code, jobs in MIDPOINTS.items())
    return F.expr(f"CASE {band} {cases} ELSE 0D END")


def normalize_stock(stock: DataFrame) -> DataFrame:
    """Stock with default members in `code_commune` and `tranche_effectifs`."""
    return stock.withColumns(
        {
            "code_commune": known_commune("code_commune"),
            "tranche_effectifs": known_band("tranche_effectifs"),
        }
    )


def normalize_history(history: DataFrame) -> DataFrame:
    """History with default members in `code_ape`, `etat` and, where present, `nomenclature_ape`."""
    columns = [c for c in ("code_ape", "etat", "nomenclature_ape") if c in history.columns]
    return history.withColumns({c: or_unknown(c) for c in columns})
