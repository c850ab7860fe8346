"""Loading a growing history folder chunk by chunk.

New files are read as a stream, a fixed number per chunk, until none is left (`availableNow`). Each
chunk goes through the same operators as a full build, so the fact does not depend on how the files
were cut, and a chunk repeated after a failure changes nothing.

What a chunk needs of the past lies beside its progress (`LoadState`): the retained establishments
and their periods so far, in directories by the hash bucket of siret that the fact has too. A chunk
adds its own periods, then reads the buckets that it touches, in the state and in the fact, and
publishes the parts of the fact that hold its establishments. Neither the history folder nor the
stock is read again, and nothing is kept of an establishment out of scope. Only a call with another
stock than the last one goes through all keys: the state is then written anew for it, and the
establishments that it has gained get their past from the folder.

Dimensions only gain rows: a code keeps the nomenclature of the load that brought it, also when files
that arrive later show another one.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.operators.joins import restrict_history
from periodica.plans.build import merge_month
from periodica.plans.warehouse import FACT, Folder, Warehouse, slot_of
from periodica.schemas import HISTORY_NAMES, HISTORY_SOURCE
from periodica.sources.register import headcount_bands, scan_history, short_names

#: Batch of the periods that a new state begins with.
BEFORE = -1
FINGERPRINT = "n long, sum string, buckets int"


def checkpoint_folder(root: str, history_path: str) -> str:
    """Progress of one history folder into one warehouse: below the warehouse's root."""
    name = hashlib.sha256(history_path.rstrip("/").encode()).hexdigest()[:16]
    return f"{root.rstrip('/')}/_checkpoints/{name}"


class LoadState:
    """Retained establishments and their periods so far, in numbered generations below a folder.

    A generation counts once its `fingerprint` is written, the last step of `renew`.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.buckets = spark, buckets
        self._folder = Folder(spark, path)

    def _generations(self) -> list[int]:
        """Complete generations, the newest first."""
        names = [n for n in self._folder.names() if "fingerprint" in self._folder.names(n)]
        return sorted((int(n.removeprefix("generation=")) for n in names), reverse=True)

    def _path(self, what: str, generation: int | None = None) -> str:
        if generation is None:
            generation = self._generations()[0]
        return f"{self._folder.path}/generation={generation}/{what}"

    def exists(self) -> bool:
        return bool(self._generations())

    def fingerprint(self, stock: DataFrame) -> tuple:
        """Tells one stock from another; the order of its rows is no matter."""
        row = stock.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64(*sorted(stock.columns)).cast("decimal(38,0)")).cast("string").alias("sum"),
        ).first()
        return row["n"], row["sum"], self.buckets

    def is_of(self, mark: tuple) -> bool:
        if not self.exists():
            return False
        found = self.spark.read.schema(FINGERPRINT).json(self._path("fingerprint")).first()
        return tuple(found) == mark

    def renew(self, stock: DataFrame, mark: tuple, past: DataFrame | None) -> None:
        """A generation for this stock. `past` has the periods loaded so far, of all establishments;
        it is read for those that the last generation lacks, all of them where there is none."""
        old = self._generations()
        number = old[0] + 1 if old else 0
        self._folder.delete(f"generation={number}")
        slot = slot_of("siret", self.buckets)
        scope = stock.withColumn("slot", slot).hint("rebalance", "slot")
        scope.write.partitionBy("slot").parquet(self._path("scope", number))
        entrants, kept = stock.select("siret"), None
        if old:
            kept = self.periods().join(entrants, "siret", "left_semi")
            entrants = entrants.join(self.scope().select("siret"), "siret", "left_anti")
        if past is not None:
            gained = restrict_history(past, entrants)
            kept = gained if kept is None else kept.unionByName(gained, allowMissingColumns=True)
        if kept is not None:
            self._write(kept, BEFORE, number)
        line = self.spark.createDataFrame([mark], FINGERPRINT)
        line.coalesce(1).write.json(self._path("fingerprint", number))
        for generation in old:
            self._folder.delete(f"generation={generation}")

    def _write(self, periods: DataFrame, batch: int, generation: int | None = None) -> None:
        """A batch written again replaces itself, slot by slot."""
        rows = periods.withColumns(
            {"slot": slot_of("siret", self.buckets), "batch": F.lit(batch)}
        )
        # a slot with a crowded establishment is split over several tasks
        rows.hint("rebalance", "slot").write.partitionBy("slot", "batch").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(self._path("periods", generation))

    def scope(self, slots: Iterable[int] | None = None) -> DataFrame:
        """Retained establishments, of some slots."""
        rows = self.spark.read.parquet(self._path("scope"))
        return (rows if slots is None else rows.filter(F.col("slot").isin(*slots))).drop("slot")

    def add(self, chunk: DataFrame, batch: int) -> None:
        """Keep the chunk's periods of retained establishments."""
        slots = chunk.select(slot_of("siret", self.buckets).alias("slot")).distinct().collect()
        scope = self.scope([row["slot"] for row in slots])
        self._write(restrict_history(chunk, scope), batch)

    def _rows(self) -> DataFrame:
        names = list(HISTORY_NAMES.values())
        fields = zip(names, [f.dataType.simpleString() for f in HISTORY_SOURCE], strict=True)
        schema = ", ".join(f"{name} {kind}" for name, kind in fields) + ", slot int, batch int"
        if "periods" not in self._folder.names(f"generation={self._generations()[0]}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path("periods"))

    def slots(self, batch: int) -> list[int]:
        """Slots that a batch touches; read from the directories alone."""
        found = self._rows().filter(F.col("batch") == batch).select("slot").distinct().collect()
        return sorted(row["slot"] for row in found)

    def periods(self, slots: Iterable[int] | None = None, without: int | None = None) -> DataFrame:
        """Periods so far, of some slots, without those of one batch."""
        rows = self._rows()
        if slots is not None:
            rows = rows.filter(F.col("slot").isin(*slots))
        if without is not None:
            rows = rows.filter(F.col("batch") != without)
        return rows.drop("slot", "batch")

    def batch(self, number: int) -> DataFrame:
        return self._rows().filter(F.col("batch") == number).drop("slot", "batch")


def load_chunks(
    spark: SparkSession,
    history_path: str,
    stock: DataFrame,
    root: str,
    *,
    files_per_chunk: int = 1,
    departements: Iterable[str] | None = None,
    rules: str = "decided",
    as_of: dt.date | None = None,
    checkpoint: str | None = None,
) -> Warehouse:
    """Load the files not loaded yet into the warehouse at `root`."""
    as_of = as_of or dt.date.today()
    warehouse = Warehouse(spark, root)
    warehouse.create_schema()
    warehouse.insert("dim_tranche_effectifs", headcount_bands(spark))
    departements = None if departements is None else list(departements)
    checkpoint = checkpoint or checkpoint_folder(root, history_path)
    state = LoadState(spark, f"{checkpoint}-state", warehouse.buckets)

    def merge(loaded: DataFrame, batch: DataFrame, scope: DataFrame, same_stock: bool) -> None:
        merge_month(
            warehouse,
            loaded,
            batch,
            scope,
            departements=departements,
            rules=rules,
            as_of=as_of,
            same_stock=same_stock,
        )

    mark, last = state.fingerprint(stock), warehouse.last_load()
    if not state.is_of(mark):
        # periods of earlier chunks, or of a build, may have been loaded
        begun = state.exists() or "offsets" in Folder(spark, checkpoint).names()
        begun = begun or bool(warehouse.state(FACT).parts)
        state.renew(stock, mark, scan_history(spark, history_path) if begun else None)
        merge(state.periods(), state.periods([]), state.scope(), same_stock=False)
    elif last is not None and last[1] != as_of:
        merge(state.periods(), state.periods([]), state.scope(), same_stock=True)

    def load(chunk: DataFrame, number: int) -> None:
        state.add(short_names(chunk, HISTORY_NAMES), number)
        slots = state.slots(number)
        if slots:
            scope = state.scope(slots)
            merge(state.periods(slots, without=number), state.batch(number), scope, same_stock=True)

    query = (
        spark.readStream.schema(HISTORY_SOURCE)
        .option("maxFilesPerTrigger", files_per_chunk)
        .parquet(history_path)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return warehouse
