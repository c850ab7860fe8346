"""Session settings the jobs are written for; a cluster's own session is used as it is."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Joins on `siret` are re-planned from run-time sizes: small sides become broadcast joins,
    # large partitions of a join are split, small ones are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Recording the call site of every column makes up half of the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share for scratch tables, `spark.checkpoint.dir`.

    A local session without one gets a folder of its own. On a cluster a folder of one machine would
    be unseen by the others, so there the setting is needed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="periodica-")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def local_session(cores: str | int = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and the bench: one JVM, no web page."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("periodica")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
