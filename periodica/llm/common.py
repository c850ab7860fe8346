"""Helpers that several operators share: scans, scratch tables, ids, the learning split."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.session import shared_folder

#: Fixed value: the white space of the contracts, space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), whatever else `docs` carries; a null text counts as empty."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text)


Batch = TypeVar("Batch", pa.RecordBatch, pa.Array)
#: Rows of an Arrow batch that become Python objects together.
ROWS = 500


def sliced(batch: Batch) -> Iterator[Batch]:
    """An Arrow batch or array in slices, so that a worker holds few of its texts as Python strings."""
    for first in range(0, len(batch), ROWS):
        yield batch.slice(first, ROWS)


def learnable(doc_id: Column) -> Column:
    """Rows a model may learn from: crc32 of the id as text is no multiple of five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


#: Frees the shuffle files of a finished write; without it they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back: lineage is cut, files outlive executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    if scopes():
        scopes()[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


LOCAL = threading.local()


def scopes() -> list[list[str]]:
    """Paths of the scratch tables of the calls of `settled` that are under way in this thread."""
    if not hasattr(LOCAL, "scopes"):
        LOCAL.scopes = []
    return LOCAL.scopes


def settled(build: Callable[[], DataFrame]) -> DataFrame:
    """Store what `build` returns; the scratch tables that it made on the way are deleted."""
    scopes().append([])
    try:
        df = build()
    finally:
        made = scopes().pop()
    out = stored(df)
    spark = out.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in made:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return out


def fan_out(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(taken: Sequence[str], wish: str) -> str:
    """A column name that `taken` lacks, whatever its case."""
    lower = {x.lower() for x in taken}
    while wish.lower() in lower:
        wish += "_"
    return wish
