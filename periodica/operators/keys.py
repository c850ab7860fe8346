"""One row per key, and idempotent loading by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, key: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The first row of each key.

    `row_number() = 1` is cut to one row per key inside each map task before the shuffle
    (`WindowGroupLimit`), so a crowded key sends one row per task, not all its rows.
    """
    by_key = W.partitionBy(*key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(by_key)).filter("_rank = 1").drop("_rank")
    )


def insert_if_absent(
    existing: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Rows of `batch` to append: keys absent from `existing`, one row per key.

    An existing key wins. Among the rows of a new key the least in `order` wins (by default over
    all other columns, so the result does not depend on arrival). NULL keys are no keys: they are
    left out, and show up in the not-null report of the batch.
    """
    if order is None:
        order = [F.asc_nulls_last(c) for c in batch.columns if c not in key] or list(key)
    keyed = batch.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]))
    return first_per_key(keyed, key, order).join(
        existing.select(*key), list(key), "left_anti"
    )
