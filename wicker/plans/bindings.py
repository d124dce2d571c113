"""Observations out of the order tables: who sold what, where, when and for how much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chain_of(store: str) -> list[Column]:
    """The chain of a store, and its group."""
    return [F.concat(F.lit(f"{name} "), (F.col(store) % n).cast("string")).alias(alias) for name, n, alias in (("CHAIN", 4, "chain"), ("GROUP", 2, "chain_group"))]


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each order line: product_id, store_id, chain, chain_group,
    place_id, date, week, item, content, price, unit_price, flag, status."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    shop = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    line = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).join(shop, F.col("l_suppkey") == F.col("s_suppkey"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return line.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        *chain_of("l_suppkey"),
        F.col("n_regionkey").alias("place_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.trunc(F.col("l_shipdate").cast("date"), "week").alias("week"),
        F.col("p_type").alias("item"),
        F.col("p_size").alias("content"),
        price.alias("price"),
        (price / F.col("p_size")).alias("unit_price"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


#: The same in SQL.
OBS = """obs AS (
  SELECT l_partkey AS product_id, l_suppkey AS store_id, 'CHAIN ' || (l_suppkey % 4) AS chain, 'GROUP ' || (l_suppkey % 2) AS chain_group,
         n_regionkey AS place_id, CAST(l_shipdate AS DATE) AS date, CAST(date_trunc('week', l_shipdate) AS DATE) AS week, p_type AS item,
         p_size AS content, l_extendedprice / l_quantity AS price, l_extendedprice / l_quantity / p_size AS unit_price,
         l_returnflag AS flag, l_linestatus AS status
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
