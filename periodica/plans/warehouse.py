"""Stored star schema: Parquet directories, and a list of the parts that are published.

Every write goes to a new directory, `version=N` below its table, and one line in `_published` then
names the parts that make up the table from now on. Readers take the last line of a table, so they
see a whole old or a whole new state, and a plan may read the table it replaces. One writer at a time.

A part of a dimension is a directory of rows; dimensions only gain rows, so a load adds a directory.
A part of the fact is one department and one slot, the hash bucket of siret, so a run of some
departments or a merge of some establishments writes only theirs. Spark reads the fact as a table
bucketed by siret whose partitions are the published parts: questions per establishment need no
shuffle, a lookup reads one bucket and asks the Bloom filters of its row groups.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from periodica.functions.territory import departement_of
from periodica.operators.keys import insert_if_absent
from periodica.schemas import PARTITION_COLUMN, PRIMARY_KEYS, TABLES, stored_schema

FACT = "fait_etablissement_version"
#: Buckets of siret in a new warehouse; a bucket of the largest department should fit a task.
BUCKETS = 8
#: A dimension with more directories is written again as one.
MOST_PARTS = 16
PUBLISHED = (
    "table_name string, version int, rows_written long, stamp string, buckets int,"
    " parts array<struct<departement: string, slot: int, version: int>>"
)
LOADS = "load int, rules string, as_of date"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
BLOOM = {
    "parquet.bloom.filter.enabled#siret": "true",
    # the smallest filter that holds a row group's keys
    "parquet.bloom.filter.adaptive.enabled": "true",
}


class Part(NamedTuple):
    departement: str | None
    slot: int | None
    version: int


class State(NamedTuple):
    """A published state of a table."""

    version: int
    stamp: str
    buckets: int
    parts: tuple[Part, ...]


def with_departement(fact: DataFrame) -> DataFrame:
    """Overseas departments have three characters here, so that each has its own directory."""
    return fact.withColumn("code_departement", departement_of("code_commune", overseas=True))


def slot_of(siret: str | Column, buckets: int) -> Column:
    """The bucket in which Spark writes a siret."""
    return F.pmod(F.hash(siret), F.lit(buckets))


def by_departement(fact: DataFrame) -> DataFrame:
    """Versions laid out for a write by department.

    `rebalance` brings a department together but splits one that is too large for a task, and the
    order by siret lets a lookup skip row groups.
    """
    rows = with_departement(fact).hint("rebalance", "code_departement")
    return rows.sortWithinPartitions("code_departement", "siret", "valid_from")


def write_fact(fact: DataFrame, path: str) -> str:
    """Write versions by department; a rerun replaces the departments it contains."""
    by_departement(fact).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).options(**BLOOM).partitionBy("code_departement").parquet(path)
    return path


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(stored_schema(FACT)).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10_000, **options) -> None:
    """Append to a database table in batches, from the executors."""
    df.write.format("jdbc").options(
        url=url, dbtable=table, batchsize=batch_size, **options
    ).mode("append").save()


class Folder:
    """Directories on any file system that Spark can write."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        given = self._path(path)
        self._files = given.getFileSystem(self._conf)
        self.path = self._files.makeQualified(given).toString()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, below: str = "") -> list[str]:
        """Names of the directories right below."""
        path = self._path(f"{self.path}/{below}")
        if not self._files.exists(path):
            return []
        found = self._files.listStatus(path)
        return sorted(status.getPath().getName() for status in found if status.isDirectory())

    def delete(self, below: str) -> bool:
        return self._files.delete(self._path(f"{self.path}/{below}"), True)


class Warehouse:
    """`buckets` counts for a new warehouse; an existing one keeps its own."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self._folder = Folder(spark, root.rstrip("/"))
        self.root = self._folder.path
        self._new_buckets = buckets

    def _lines(self, folder: str, schema: str) -> DataFrame | None:
        if folder not in self._folder.names():
            return None
        return self.spark.read.schema(schema).json(f"{self.root}/{folder}")

    def _append(self, folder: str, **values) -> None:
        line = self.spark.range(1, numPartitions=1).select(F.lit(json.dumps(values)).alias("value"))
        line.write.mode("append").text(f"{self.root}/{folder}")

    def _states(self, last: int = 1) -> dict[str, list[State]]:
        """The last published states of each table, the newest first."""
        published = self._lines("_published", PUBLISHED)
        if published is None:
            return {}
        newest = F.sort_array(F.collect_list(F.struct("version", "stamp", "buckets", "parts")), False)
        rows = published.groupBy("table_name").agg(F.slice(newest, 1, last).alias("states")).collect()
        return {
            row["table_name"]: [
                State(s["version"], s["stamp"], s["buckets"], tuple(Part(*p) for p in s["parts"]))
                for s in row["states"]
            ]
            for row in rows
        }

    def state(self, table: str) -> State:
        return self._states()[table][0]

    @property
    def buckets(self) -> int:
        states = self._states()
        return states[FACT][0].buckets if FACT in states else self._new_buckets

    def _announce(self, table: str, state: State, rows: int) -> None:
        self._append(
            "_published",
            table_name=table,
            version=state.version,
            rows_written=rows,
            stamp=state.stamp,
            buckets=state.buckets,
            parts=[part._asdict() for part in state.parts],
        )

    def last_load(self) -> tuple[str, dt.date] | None:
        """Rules and `as_of` of the last load."""
        lines = self._lines("_loads", LOADS)
        last = None if lines is None else lines.orderBy(F.desc("load")).first()
        return None if last is None else (last["rules"], last["as_of"])

    def note_load(self, rules: str, as_of: dt.date) -> None:
        lines = self._lines("_loads", LOADS)
        number = 0 if lines is None else lines.agg(F.max("load")).first()[0] or 0
        self._append("_loads", load=number + 1, rules=rules, as_of=as_of.isoformat())

    def vacuum(self, keep: int = 1) -> int:
        """Delete the directories that none of the last `keep` states of their table names; returns
        how many went. What has left the published table, an establishment that opted out among it,
        is then gone from disk. Run it when no reader holds an older state."""
        deleted = 0
        for table, states in self._states(last=1 << 30).items():
            for old in states[keep:]:
                self.spark.sql(f"DROP TABLE IF EXISTS {_name(old)}")
            live = {_place(part) for state in states[:keep] for part in state.parts}
            held = {place.split("/")[0] for place in live}
            for version in self._folder.names(table):
                if version not in held:
                    deleted += self._folder.delete(f"{table}/{version}")
                elif table in PARTITION_COLUMN:
                    for part in self._written(table, int(version.removeprefix("version="))):
                        if _place(part) not in live:
                            deleted += self._folder.delete(f"{table}/{_place(part)}")
        return deleted

    def _written(self, table: str, version: int) -> Iterator[Part]:
        """The parts of the fact in the directory of a version."""
        top = f"{table}/version={version}"
        for departement in self._folder.names(top):
            code = departement.removeprefix("code_departement=")
            for slot in self._folder.names(f"{top}/{departement}"):
                number = int(slot.removeprefix("slot="))
                yield Part(None if code == NO_VALUE else code, number, version)

    def create_schema(self) -> None:
        """Create the tables that do not exist yet, empty."""
        existing = self._states()
        for table in TABLES:
            if table not in existing:
                self._announce(table, State(0, _stamp(), self._new_buckets, ()), 0)

    def _ddl(self, table: str, name: str, buckets: int, path: str) -> str:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored_schema(table))
        options = ", ".join(f"'{key}' = '{value}'" for key, value in BLOOM.items())
        return (
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, slot int) USING parquet"
            f" OPTIONS ({options}) PARTITIONED BY ({PARTITION_COLUMN[table]}, slot)"
            f" CLUSTERED BY (siret) SORTED BY (siret) INTO {buckets} BUCKETS"
            f" LOCATION '{_quoted(path)}'"
        )

    def _frame(self, table: str, state: State) -> DataFrame:
        """The rows of a state, published or not."""
        top = f"{self.root}/{table}"
        if table not in PARTITION_COLUMN:
            if not state.parts:
                return self.spark.createDataFrame([], stored_schema(table))
            paths = [f"{top}/{_place(part)}" for part in state.parts]
            return self.spark.read.schema(stored_schema(table)).parquet(*paths)
        name = _name(state)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(self._ddl(table, name, state.buckets, top))
            specs = [
                f"PARTITION (code_departement = {_literal(p.departement)}, slot = {p.slot})"
                f" LOCATION '{_quoted(f'{top}/{_place(p)}')}'"
                for p in state.parts
            ]
            for first in range(0, len(specs), 500):
                some = " ".join(specs[first : first + 500])
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {some}")
        return self.spark.table(name)

    def read(self, table: str) -> DataFrame:
        """Published rows; the fact also has `code_departement` and `slot`, which prune directories."""
        return self._frame(table, self.state(table))

    def tables(self) -> dict[str, DataFrame]:
        return {table: self._frame(table, states[0]) for table, states in self._states().items()}

    def register_views(self) -> None:
        """Make every table a view of its own name, for questions in SQL."""
        for table, df in self.tables().items():
            df.createOrReplaceTempView(table)

    def stage(self, table: str, df: DataFrame, **counts: Column) -> Staged:
        """Write rows that nobody sees yet. The counts, and the number of rows, are observed in the
        tasks that write, so no second pass reads them; a task run twice counts once."""
        state = self.state(table)
        version = state.version + 1
        top = f"{self.root}/{table}/version={version}"
        # an unpublished leftover of a failed run may lie there
        self._folder.delete(f"{table}/version={version}")
        columns = [f.name for f in TABLES[table].fields]
        seen = Observation()
        counts = {"rows": F.count(F.lit(1)), **counts}
        observed = [count.alias(name) for name, count in counts.items()]
        if table not in PARTITION_COLUMN:
            df.observe(seen, *observed).select(columns).write.parquet(top)
            parts = (Part(None, None, version),)
        else:
            name = f"staged_{_stamp()}"
            rows = with_departement(df).withColumn("slot", slot_of("siret", state.buckets))
            # one task for each part, so one file for each
            rows = rows.repartition("code_departement", "slot").observe(seen, *observed)
            self.spark.sql(self._ddl(table, name, state.buckets, top))
            try:
                rows.select(*columns, "code_departement", "slot").write.insertInto(name)
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            parts = tuple(self._written(table, version))
        found = {name: value or 0 for name, value in seen.get.items()}
        return Staged(self, table, state, parts, found)

    def publish(
        self,
        table: str,
        df: DataFrame,
        allow_empty: bool = False,
        verify: Callable[[DataFrame], None] | None = None,
    ) -> int:
        """Replace a table; returns its number of rows. With no rows nothing is published.

        `verify` gets the written rows and stops the publication by raising.
        """
        staged = self.stage(table, df)
        if staged.counts["rows"] or allow_empty:
            staged.publish(verify=verify)
        else:
            staged.discard()
        return staged.counts["rows"]

    def insert(
        self, table: str, batch: DataFrame, order: Sequence[Column | str] | None = None
    ) -> int:
        """Add the rows whose key is not there yet; repeating it adds nothing. Returns how many."""
        batch = batch.select([f.name for f in TABLES[table].fields])
        new = insert_if_absent(self.read(table), batch, PRIMARY_KEYS[table], order)
        staged = self.stage(table, new)
        if staged.counts["rows"] == 0:
            staged.discard()
        else:
            staged.publish(lambda part: False)
            if len(self.state(table).parts) > MOST_PARTS:
                self.publish(table, self.read(table).coalesce(1))
        return staged.counts["rows"]


class Staged:
    """Rows that are written and not yet published."""

    def __init__(
        self, warehouse: Warehouse, table: str, before: State, parts: tuple[Part, ...], counts: dict
    ):
        self._warehouse, self._table, self._before = warehouse, table, before
        self.parts, self.counts = parts, counts

    def publish(
        self,
        replaced: Callable[[Part], bool] = lambda part: True,
        verify: Callable[[DataFrame], None] | None = None,
    ) -> None:
        """Put the staged parts in the place of those `replaced`; the others stay. One line does it."""
        kept = tuple(part for part in self._before.parts if not replaced(part))
        version = self._before.version + 1
        state = State(version, _stamp(), self._before.buckets, (*kept, *self.parts))
        places = [part[:2] for part in state.parts if part.slot is not None]
        if len(set(places)) < len(places):
            raise ValueError("a written part has the place of one that stays")
        if verify is not None:
            verify(self._warehouse._frame(self._table, state))
        self._warehouse._announce(self._table, state, self.counts["rows"])

    def discard(self) -> None:
        self._warehouse._folder.delete(f"{self._table}/version={self._before.version + 1}")


def _stamp() -> str:
    return uuid.uuid4().hex


def _name(state: State) -> str:
    """The session's name for a state of the fact."""
    return f"periodica_{state.stamp}"


def _place(part: Part) -> str:
    top = f"version={part.version}"
    if part.slot is None:
        return top
    return f"{top}/code_departement={part.departement or NO_VALUE}/slot={part.slot}"


def _quoted(text: str) -> str:
    return re.sub(r"(['\\])", r"\\\1", text)


def _literal(text: str | None) -> str:
    return "null" if text is None else f"'{_quoted(text)}'"
