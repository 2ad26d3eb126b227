"""The modelling table derived from orders, customers, nations and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that opening a table starts no job to look at its files.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{data_dir}/{name}.parquet")


def order_profile(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per order; the target is the value of its returned lines.

    Line items are reduced to one row per order before any join, with map-side
    combine, so an order with very many lines costs nothing at the shuffle.
    Money is summed in integer cents, which makes the sum independent of order.
    No side is marked for broadcast: Spark measures them, and adaptive execution
    splits the orders of a customer who holds a large share of them.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    lines = (
        table(spark, data_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("record_id"))
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").alias("qty"),
            F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("disc_pts"),
            F.sum(F.when(F.col("l_returnflag") == "R", cents)).alias("returned_cents"),
        )
    )
    buyers = (
        table(spark, data_dir, "customer")
        .join(table(spark, data_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey"),
            F.col("c_acctbal").alias("acctbal"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("nation"),
        )
    )
    orders = table(spark, data_dir, "orders").select(
        F.col("o_orderkey").alias("record_id"),
        F.col("o_custkey"),
        F.col("o_totalprice").alias("totalprice"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )

    def filled(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast("double")

    return (
        orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(lines, "record_id", "left")
        .select(
            "record_id",
            filled("n_lines").alias("n_lines"),
            filled("qty").alias("qty"),
            filled("disc_pts").alias("disc_pts"),
            "totalprice",
            "acctbal",
            "status",
            "priority",
            "segment",
            "nation",
            (filled("returned_cents") / 100).alias("target"),
        )
    )
