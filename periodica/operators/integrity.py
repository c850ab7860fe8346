"""Key, reference, not-null and length checks, returned as violation rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.schemas import (
    FOREIGN_KEYS,
    MAX_LENGTHS,
    PRIMARY_KEYS,
    TABLES,
    required_columns,
)

FACT = "fait_etablissement_version"


class IntegrityError(ValueError):
    """A table breaks the schema."""


def duplicate_keys(df: DataFrame, table: str) -> DataFrame:
    key = PRIMARY_KEYS[table]
    counts = df.groupBy(*key).agg(F.count("*").alias("nb")).filter("nb > 1")
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit("primary_key").alias("rule"),
        F.lit(",".join(key)).alias("column_name"),
        F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("key"),
        "nb",
    )


def orphan_keys(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact keys without a dimension row, for the given dimensions.

    One pass over the fact: all key columns are counted together, per (column, key) inside the map
    tasks, and only the distinct keys are joined with the dimensions.
    """
    checked = {c: ref for c, ref in FOREIGN_KEYS.items() if ref[0] in dims}

    def entry(column: str) -> Column:
        return F.struct(
            F.lit(column).alias("column_name"), F.col(column).cast("string").alias("key")
        )

    used = (
        fact.select(F.inline(F.array(*[entry(c) for c in checked])))
        .filter(F.col("key").isNotNull())
        .groupBy("column_name", "key")
        .agg(F.count("*").alias("nb"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dims[table].select(
                F.lit(column).alias("column_name"), F.col(key).cast("string").alias("key")
            )
            for column, (table, key) in checked.items()
        ],
    )
    rule = F.create_map(
        *[F.lit(x) for c, (table, _) in checked.items() for x in (c, f"foreign_key:{table}")]
    )
    return used.join(known, ["column_name", "key"], "left_anti").select(
        F.lit(FACT).alias("table_name"),
        rule[F.col("column_name")].alias("rule"),
        "column_name",
        "key",
        "nb",
    )


def column_rules(df: DataFrame, table: str) -> DataFrame:
    """Not-null and length rules of a table, all counted in one pass."""
    checks = _checks(table)
    counts = df.agg(*[F.count_if(test).alias(f"n{i}") for i, (_, _, test) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column_name"),
                F.col(f"n{i}").alias("nb"),
            )
            for i, (rule, column, _) in enumerate(checks)
        ]
    )
    return (
        counts.select(F.explode(rows).alias("r"))
        .select(
            F.lit(table).alias("table_name"),
            "r.rule",
            "r.column_name",
            F.lit(None).cast("string").alias("key"),
            "r.nb",
        )
        .filter("nb > 0")
    )


def _checks(table: str) -> list[tuple[str, str, Column]]:
    """Rule, column and test of each not-null and length rule."""
    checks = [("not_null", c, F.col(c).isNull()) for c in required_columns(table)]
    for column, size in MAX_LENGTHS.get(table, {}).items():
        checks.append((f"max_length:{size}", column, F.length(column) > size))
    return checks


ENTRY = ("ref", "ref_key", "is_known", "table_name", "rule", "column_name", "key", "nb")


def _entry(**values) -> Column:
    given = {"ref": None, "ref_key": None, "is_known": False, "key": None, "nb": 0, **values}
    kinds = {"is_known": "boolean", "nb": "long"}

    def column(name: str) -> Column:
        value = given.get(name)
        value = value if isinstance(value, Column) else F.lit(value)
        return value.cast(kinds.get(name, "string")).alias(name)

    return F.struct(*[column(name) for name in ENTRY])


def counted_rules(df: DataFrame, table: str, dims: set[str]) -> DataFrame:
    """Everything that the rules of a table need, from one pass: rows of ENTRY.

    Grouping sets count the rows per primary key, per value of each column that refers to one of
    `dims`, and, over the whole table, those that break a not-null or length rule. All are reduced
    inside the map tasks; only primary keys are as many as the rows. The keys of a dimension are
    entries too, `is_known`.
    """
    key = PRIMARY_KEYS[table]
    foreign = {c: ref for c, ref in FOREIGN_KEYS.items() if table == FACT and ref[0] in dims}
    columns = list(dict.fromkeys([*key, *foreign]))
    sets = [list(key), *[[c] for c in foreign], []]
    checks = _checks(table)
    counts = df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().alias("set_id"),
        F.count(F.lit(1)).alias("nb"),
        *[F.count_if(test).alias(f"n{i}") for i, (_, _, test) in enumerate(checks)],
    )

    def set_id(columns_in: list[str]) -> int:
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in columns_in)

    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    repeated = _entry(
        table_name=table, rule="primary_key", column_name=",".join(key), key=text, nb=F.col("nb")
    )
    own = [F.when(F.col("nb") > 1, repeated)]
    if table in dims:
        known = F.col(key[0]).isNotNull()
        own.append(F.when(known, _entry(ref=table, ref_key=text, is_known=True, table_name=table)))
    found = F.when(F.col("set_id") == set_id(list(key)), F.array(*own))
    for column, (dim, _) in foreign.items():
        value = F.col(column).cast("string")
        used = _entry(
            ref=dim, ref_key=value, table_name=table, rule=f"foreign_key:{dim}",
            column_name=column, key=value, nb=F.col("nb"),
        )
        found = found.when(
            F.col("set_id") == set_id([column]), F.array(F.when(value.isNotNull(), used))
        )
    broken = [
        F.when(F.col(f"n{i}") > 0, _entry(table_name=table, rule=r, column_name=c, nb=F.col(f"n{i}")))
        for i, (r, c, _) in enumerate(checks)
    ]
    found = found.otherwise(F.array(*broken))
    entries = counts.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("entry"))
    return entries.select("entry.*")


def integrity_report(
    tables: Mapping[str, DataFrame], fail_on_violation: bool = False
) -> DataFrame:
    """Violations (`table_name, rule, column_name, key, nb`) of the given warehouse tables.

    Each table is read once. References meet the keys of their dimension by (dimension, key); every
    such group holds a row for each column that refers to the dimension, and one for the key.
    """
    dims = {name for name, _ in FOREIGN_KEYS.values() if name in tables}
    counted = [counted_rules(tables[name], name, dims) for name in TABLES if name in tables]
    entries = reduce(DataFrame.unionByName, counted)
    # a violation that refers to nothing is a group of its own
    alone = F.concat_ws("/", "table_name", "rule", "column_name", "key")
    entries = entries.withColumn("ref_key", F.coalesce("ref_key", alone))
    row = F.struct("table_name", "rule", "column_name", "key", "nb")
    groups = entries.groupBy("ref", "ref_key").agg(
        F.max("is_known").alias("is_known"),
        F.collect_list(F.when(~F.col("is_known"), row)).alias("rows"),
    )
    report = groups.filter(~F.col("is_known")).select(F.inline("rows"))
    if fail_on_violation:
        sample = report.limit(5).collect()
        if sample:
            raise IntegrityError("; ".join(str(tuple(row)) for row in sample))
    return report


def distinct_check(df: DataFrame, key: str) -> DataFrame:
    """One row: number of rows and of distinct keys."""
    return df.agg(F.count("*").alias("total"), F.count_distinct(key).alias("distincts"))
