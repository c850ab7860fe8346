"""Models: named source -> staging view -> mart, each a view or a stored table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.operators.dims import mart_dim_commune
from periodica.sources.register import Sources


def materialize(
    df: DataFrame, name: str, materialized: str = "view", bucket_by: tuple[int, str] | None = None
) -> DataFrame:
    """Register a result as a view, or store it as a table.

    A view costs nothing and is computed at each read. A table can be bucketed: with
    `(n, "siret")` later grouping, windows and joins on siret need no shuffle.
    """
    spark = df.sparkSession
    if materialized == "view":
        df.createOrReplaceTempView(name)
    elif materialized == "table":
        if bucket_by is not None:
            n, column = bucket_by
            # one task per bucket, so one sorted file per bucket
            df.repartition(n, column).write.bucketBy(n, column).sortBy(column).mode(
                "overwrite"
            ).format("parquet").saveAsTable(name)
        else:
            df.write.mode("overwrite").format("parquet").saveAsTable(name)
    else:
        raise ValueError(f"unknown materialization {materialized!r}")
    return spark.table(name)


@dataclass(frozen=True)
class Model:
    """`build` receives the run, and reads its inputs with `source` and `ref`."""

    name: str
    build: Callable[[Run], DataFrame]
    materialized: str = "view"


class Run:
    """Builds models in the given order; `ref` reads a model built before."""

    def __init__(self, sources: Sources):
        self._sources = sources
        self._built: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return self._sources.read(name)

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            raise KeyError(f"model {name!r} is not built yet")
        return self._built[name]

    def run(self, models: list[Model]) -> dict[str, DataFrame]:
        for model in models:
            self._built[model.name] = materialize(
                model.build(self), model.name, model.materialized
            )
        return dict(self._built)


def staged_periods(periods: DataFrame) -> DataFrame:
    """Staging: the published period columns in snake case."""
    return periods.select(
        "siret",
        F.col("dateDebut").alias("date_debut"),
        F.col("dateFin").alias("date_fin"),
        "etat",
        "code_ape",
        "code_commune",
        "libelle_commune",
        "code_tranche",
    )


PERIODS_SOURCE = "sirene.periodes"
MODELS = [
    Model("stg_periodes", lambda run: staged_periods(run.source(PERIODS_SOURCE))),
    Model("mart_dim_commune", lambda run: mart_dim_commune(run.ref("stg_periodes"))),
]
