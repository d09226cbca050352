"""Inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_KEY_SQL = "concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gappy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with missing values: NULL and NaN numbers, NULL text and dates."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS,
        F.expr("CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN double('NaN') "
               "ELSE l_quantity END").alias("quantity"),
        F.expr("CASE WHEN l_linenumber > 5 THEN NULL ELSE l_extendedprice END").alias("price"),
        F.expr("CASE WHEN l_linenumber > 1 THEN NULL ELSE l_tax END").alias("tax"),
        F.expr("CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END").alias("flag"),
        F.expr("CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END").alias("shipped"))


GAPPY_LINES_SQL = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CASE WHEN l_linenumber >= 6 THEN NULL ELSE l_quantity END AS quantity,
    CASE WHEN l_linenumber > 5 THEN NULL ELSE l_extendedprice END AS price,
    CASE WHEN l_linenumber > 1 THEN NULL ELSE l_tax END AS tax,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END AS flag,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS shipped
    FROM lineitem)"""
