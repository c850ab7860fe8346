"""Scans of the register files, by any path Spark can read, and the declared sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from periodica.functions.members import BANDS
from periodica.operators.filters import diffusible, in_territory
from periodica.schemas import (
    DIM_TRANCHE,
    HISTORY_NAMES,
    HISTORY_SOURCE,
    PERIODES,
    STOCK_NAMES,
    STOCK_SOURCE,
)


def short_names(source: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select and rename the known columns; further columns keep their name and follow."""
    extra = [c for c in source.columns if c not in names]
    return source.selectExpr(*[f"{c} AS {names[c]}" for c in names], *extra)


def scope_stock(stock: DataFrame, departements: Iterable[str] | None = None) -> DataFrame:
    """Distributable establishments of the territory (the whole country without one)."""
    kept = diffusible(stock)
    if departements is not None:
        kept = in_territory(kept, departements)
    return kept.drop("statut_diffusion")


def scan_stock(
    spark: SparkSession, path: str, departements: Iterable[str] | None = None
) -> DataFrame:
    source = spark.read.schema(STOCK_SOURCE).parquet(path)
    return scope_stock(short_names(source, STOCK_NAMES), departements)


def scan_history(spark: SparkSession, path: str) -> DataFrame:
    return short_names(spark.read.schema(HISTORY_SOURCE).parquet(path), HISTORY_NAMES)


def headcount_bands(spark: SparkSession) -> DataFrame:
    """The sixteen reference bands."""
    return spark.createDataFrame(list(BANDS.items()), DIM_TRANCHE)


class Sources:
    """Declared external sources: `schema.table` -> location, read with a declared schema."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._declared: dict[str, tuple[str, T.StructType]] = {}

    def declare(self, name: str, location: str, schema: T.StructType = PERIODES) -> Sources:
        self._declared[name] = (location, schema)
        return self

    def read(self, name: str) -> DataFrame:
        location, schema = self._declared[name]
        return self.spark.read.schema(schema).parquet(location)
