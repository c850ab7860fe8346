"""The two register files, derived from the customer, nation and orders tables.

Rows keep the published column names, so they go through the same renaming and filters as the
files. `seq` is the arrival order of a period (tie-break on equal start dates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from periodica.operators.keys import first_per_key
from periodica.schemas import HISTORY_NAMES, STOCK_NAMES
from periodica.sources.register import short_names

# Columns used of the driver tables.
TABLES = {
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
}

SOURCE_STOCK = [
    "lpad(CAST(c_custkey AS STRING), 14, '0') AS siret",
    "lpad(CAST(c_nationkey + 60 AS STRING), 2, '0') || lpad(CAST(c_custkey % 20 AS STRING), 3, '0')"
    " AS codeCommuneEtablissement",
    "n_name || ' C' || CAST(c_custkey % 20 AS STRING) AS libelleCommuneEtablissement",
    "CASE c_custkey % 18 WHEN 0 THEN 'NN' WHEN 1 THEN '00' WHEN 2 THEN '01' WHEN 3 THEN '02'"
    " WHEN 4 THEN '03' WHEN 5 THEN '11' WHEN 6 THEN '12' WHEN 7 THEN '21' WHEN 8 THEN '22'"
    " WHEN 9 THEN '31' WHEN 10 THEN '32' WHEN 11 THEN '41' WHEN 12 THEN '42' WHEN 13 THEN '51'"
    " WHEN 14 THEN '52' WHEN 15 THEN '53' WHEN 16 THEN 'ZZ' END AS trancheEffectifsEtablissement",
    "CAST(NULL AS STRING) AS activitePrincipaleEtablissement",
    "CASE WHEN c_custkey % 10 = 0 THEN 'P' ELSE 'O' END AS statutDiffusionEtablissement",
]
SOURCE_HISTORY = [
    "lpad(CAST(o_custkey AS STRING), 14, '0') AS siret",
    "CASE WHEN o_orderkey % 997 = 0 THEN DATE'0004-01-03'"
    " WHEN o_orderkey % 991 = 0 THEN DATE'3035-01-01'"
    " ELSE CAST(o_orderdate AS DATE) END AS dateDebut",
    "last_day AS dateFin",
    "CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'A' END AS etatAdministratifEtablissement",
    "CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN '01.11Z'"
    " WHEN o_orderpriority = '2-HIGH' THEN '47.11F' WHEN o_orderpriority = '3-MEDIUM' THEN '56.10A'"
    " WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '62.01Z'"
    " WHEN o_orderpriority = '5-LOW' THEN '70.22Z' END AS activitePrincipaleEtablissement",
    "CASE WHEN CAST(o_orderdate AS DATE) < DATE'1998-01-01' THEN 'NAFRev1' ELSE 'NAFRev2' END"
    " AS nomenclatureActivitePrincipaleEtablissement",
    "o_orderkey AS seq",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def source_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation")
    return customers.join(nations, F.expr("c_nationkey = n_nationkey")).selectExpr(*SOURCE_STOCK)


def _with_last_day(orders: DataFrame) -> DataFrame:
    """Orders with the day before the customer's next order.

    The next order of all but the last order of a day is on that day. So the window only sees the
    last order of each day, at most one row per calendar day however many orders a customer has,
    and the join back is on the unique order key.
    """
    last_of_day = first_per_key(
        orders.select("o_custkey", "o_orderdate", "o_orderkey"),
        ["o_custkey", "o_orderdate"],
        [F.desc("o_orderkey")],
    )
    by_customer = W.partitionBy("o_custkey").orderBy("o_orderdate")
    following = last_of_day.select(
        "o_orderkey",
        F.lit(True).alias("closes_day"),
        F.lead("o_orderdate").over(by_customer).alias("next_day"),
    )
    next_order = F.expr("CASE WHEN closes_day THEN next_day ELSE o_orderdate END")
    return orders.join(following, "o_orderkey", "left").withColumn(
        "last_day", F.date_sub(next_order.cast("date"), 1)
    )


def source_history(spark: SparkSession, sf_dir: str, with_end: bool = True) -> DataFrame:
    """`with_end=False` leaves `dateFin` NULL and saves its window and join."""
    orders = _table(spark, sf_dir, "orders")
    if with_end:
        orders = _with_last_day(orders)
    else:
        orders = orders.withColumn("last_day", F.lit(None).cast("date"))
    return orders.selectExpr(*SOURCE_HISTORY)


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return short_names(source_stock(spark, sf_dir), STOCK_NAMES)


def history(spark: SparkSession, sf_dir: str, with_end: bool = True) -> DataFrame:
    return short_names(source_history(spark, sf_dir, with_end), HISTORY_NAMES)
