"""Every registered query against its SQL twin."""

import datetime as dt
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry
from oracle import ORACLE

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["customer", "nation", "orders"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def normal(value):
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else value


DUCK_TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "HUGEINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def test_every_query_has_a_twin():
    corpus = {"pipeline", *(registry.LLM.QUERIES if registry.LLM else ())}
    assert set(registry.queries()) - corpus == set(ORACLE)
    assert set(ORACLE) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    ours = registry.queries()[name](spark, SF)
    theirs = duck.sql(registry.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    expected_types = {c: DUCK_TYPES[str(t)] for c, t in zip(theirs.columns, theirs.types)}
    assert dict(ours.dtypes) == expected_types
    order = [theirs.columns.index(c) for c in columns]
    expected = Counter(tuple(normal(r[i]) for i in order) for r in theirs.fetchall())
    actual = Counter(tuple(normal(v) for v in r) for r in ours.select(*columns).collect())
    assert actual == expected
    assert actual, "an empty result checks nothing"


def test_entry(spark):
    assert registry.entry(spark).count() > 0
