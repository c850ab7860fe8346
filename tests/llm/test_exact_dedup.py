import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from periodica.llm.exact_dedup import ORACLE, deduplicated, exact_duplicates, op8_exact_dedup, tree_merge

SF = "/root/testdata/sf0.01"


def brute(rows):
    """(doc_id, keep_id, group_size, kept, sha) per row of (doc_id, text)."""
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        group = groups[norm(t)]
        length, _, _, keep = min(group)
        kept = i == keep and len(t or "") == -length
        out.append((i, keep, len(group), kept, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    theirs = con.sql(ORACLE["op8_exact_dedup"])
    columns = theirs.columns
    got = sorted(tuple(r) for r in op8_exact_dedup(spark, SF).select(*columns).collect())
    assert got == sorted(theirs.fetchall())


@pytest.mark.parametrize("fan_in", [2, 8])
def test_odd_rows(spark, fan_in):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (None, "a b"), (4, "ab"), (4, "ab"), (5, "a  b"),
            (6, "a b"), (7, "x" * 100_000), (8, "x" * 100_000 + " "), (None, "z"), (None, "z ")]
    rows += [(100 + i, "copy " * (1 + i % 3)) for i in range(300)]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, sha string").repartition(9)
    got = exact_duplicates(docs, fan_in=fan_in).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    left = deduplicated(docs, fan_in=fan_in)
    assert left.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    by_norm = {re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows}
    assert len(kept) == len(by_norm)
    assert {i for i, _ in kept} == {i for i, keep, _, k, _ in brute(rows) if k}
    assert exact_duplicates(docs.limit(0)).collect() == [] == deduplicated(docs.limit(0)).collect()


def test_short_digests_that_collide_stay_apart(spark):
    entries = spark.range(0, 200, 1, 7).select(
        (F.col("id") % 3).alias("digest"),
        F.sha2((F.col("id") % 20).cast("string").cast("binary"), 256).cast("binary").alias("sha"),
        F.lit(5).alias("n_norm"),
        (F.col("id") % 4).cast("int").alias("best_len"),
        F.col("id").alias("best_id"),
        F.lit(1).cast("long").alias("n_rows"),
    )
    merged = tree_merge(entries, 4, 16).collect()
    expected = {}
    for i in range(200):
        key = i % 3, i % 20
        best, n = expected.get(key, ((1, 0), 0))
        expected[key] = min(best, (-(i % 4), i)), n + 1
    found = {(r.digest, r.best_id): (r.best_len, r.n_rows) for r in merged}
    assert found == {(k[0], b[1]): (-b[0], n) for k, (b, n) in expected.items()}
    assert len(merged) == 60
