"""Readers and writers: tables are written by Spark to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import table
from tabwright.functions.columns import nan_to_null
from tabwright.functions.scratch import scratch_path
from tabwright.sources.files import (infer_types, normalise_null_tokens, read_csv, read_delimited,
                                     read_json, read_parquet)
from tabwright.sources.loading import file_source, load_clean, preview, reload
from tabwright.sources.sinks import write_table


def csv_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_table(table(spark, sf_dir, "customer"), scratch_path(spark, "csv"), "customer",
                       "csv")
    return read_csv(spark, path)


def delimited_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "part")
    table(spark, sf_dir, "part").write.csv(path, header=True, sep="|", escape='"')
    return read_delimited(spark, path, "|")


def multi_line_csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("lang", F.lit("\n\"q\", "), "source").alias("label"), "n_chars") \
        .write.csv(path, header=True, escape='"')
    return read_csv(spark, path)


def csv_of_whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "texts")
    table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("> "), "text").alias("text")) \
        .write.csv(path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False,
                   ignoreTrailingWhiteSpace=False)
    return read_csv(spark, path)


def mixed_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "encodings")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("lang", F.lit(" \u00e9\u00fc "), "source").alias("label"), "n_chars")
    for name, part in (("UTF-8", 0), ("ISO-8859-1", 1)):
        rows.where(F.col("doc_id") % 2 == part).write.csv(f"{path}/{name}", header=True,
                                                          encoding=name)
    return read_csv(spark, f"{path}/*")


# Rows per JSON document: the number of documents grows with the table, not their size.
DOCUMENT_ROWS = 1000


def json_records_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    (table(spark, sf_dir, "supplier")
     .groupBy(F.floor(F.col("s_suppkey") / DOCUMENT_ROWS).alias("d"))
     .agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(
         "s_suppkey", "s_name", "s_nationkey", "s_acctbal"))), ","), F.lit("]")).alias("value"))
     .select("d", "value").write.partitionBy("d").text(path))
    return read_json(spark, path).drop("d")


def json_columns_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    columns = ["p_partkey", "p_name", "p_size", "p_retailprice"]
    row = F.col("p_partkey").cast("string")
    (table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / DOCUMENT_ROWS).alias("d"))
     .agg(F.to_json(F.struct(*[F.map_from_entries(F.collect_list(F.struct(row, F.col(c))))
                               .alias(c) for c in columns])).alias("value"))
     .select("d", "value").write.partitionBy("d").text(path))
    return read_json(spark, path)


def parquet_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/orders.parquet")


def null_tokens_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(
        "CASE o_orderstatus WHEN 'F' THEN 'NA' WHEN 'O' THEN ' null ' ELSE o_orderpriority END")
        .alias("value"))
    return normalise_null_tokens(marked)


def infer_types_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "lineitem").selectExpr(
        "string(l_orderkey) AS whole", "string(l_extendedprice) AS fraction",
        "CASE WHEN l_linestatus = 'F' THEN 'True' ELSE 'False' END AS flag",
        "l_returnflag AS word",
        "CASE WHEN l_linenumber > 3 THEN string(l_partkey) END AS whole_or_null",
        "CASE WHEN l_linenumber = 1 THEN 'x' ELSE string(l_tax) END AS mixed")
    return infer_types(text)


def preview_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    (rows, columns), names, _ = preview(table(spark, sf_dir, "lineitem"))
    return spark.createDataFrame([(rows, columns, "|".join(names))],
                                 "row_count bigint, column_count bigint, columns string")


def load_and_reload_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = file_source(f"{sf_dir}/orders.parquet")
    first = load_clean(spark, spec)
    again = reload(spark, spec.to_json())
    count = F.count(F.lit(1))
    return (first.select("o_orderstatus", F.lit("load").alias("pass"))
            .unionByName(again.select("o_orderstatus", F.lit("reload").alias("pass")))
            .groupBy("pass", "o_orderstatus").agg(count.alias("n")))


def write_processed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_table(table(spark, sf_dir, "orders"), scratch_path(spark, "out"),
                       "processed_data", "parquet")
    return nan_to_null(spark.read.parquet(path))


QUERIES = {
    "source_csv": csv_customer,
    "source_csv_multi_line": multi_line_csv_documents,
    "source_csv_whole_texts": csv_of_whole_texts,
    "source_csv_encodings": mixed_encodings,
    "source_delimited": delimited_part,
    "source_json_records": json_records_supplier,
    "source_json_columns": json_columns_part,
    "source_parquet": parquet_orders,
    "source_null_tokens": null_tokens_orders,
    "source_infer_types": infer_types_lineitem,
    "source_preview": preview_lineitem,
    "source_load_reload": load_and_reload_orders,
    "sink_processed": write_processed_round_trip,
}

SQL = {
    "source_csv": """SELECT c_custkey::BIGINT AS c_custkey, c_name,
        c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "source_csv_multi_line": """SELECT doc_id::BIGINT AS doc_id,
        lang || chr(10) || '"q", ' || source AS label, n_chars::BIGINT AS n_chars
        FROM documents""",
    "source_csv_whole_texts": """SELECT doc_id::BIGINT AS doc_id, '> ' || text AS text
        FROM documents""",
    "source_csv_encodings": """SELECT doc_id::BIGINT AS doc_id,
        lang || ' ' || chr(233) || chr(252) || ' ' || source AS label, n_chars::BIGINT AS n_chars
        FROM documents""",
    "source_delimited": """SELECT p_partkey::BIGINT AS p_partkey, p_name, p_brand, p_type,
        p_size::BIGINT AS p_size, p_retailprice FROM part""",
    "source_json_records": """SELECT s_suppkey::BIGINT AS s_suppkey, s_name,
        s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier""",
    "source_json_columns": """SELECT p_partkey::BIGINT AS p_partkey, p_name,
        p_size::BIGINT AS p_size, p_retailprice FROM part""",
    "source_parquet": "SELECT * FROM orders",
    "source_null_tokens": """SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('F', 'O')
        THEN o_orderpriority END AS value FROM orders""",
    "source_infer_types": """SELECT l_orderkey::BIGINT AS whole, l_extendedprice AS fraction,
        l_linestatus = 'F' AS flag, l_returnflag AS word,
        CASE WHEN l_linenumber > 3 THEN l_partkey::BIGINT END AS whole_or_null,
        CASE WHEN l_linenumber = 1 THEN 'x' ELSE l_tax::VARCHAR END AS mixed FROM lineitem""",
    "source_preview": """SELECT (SELECT count(*) FROM lineitem)::BIGINT AS row_count,
        count(*)::BIGINT AS column_count,
        string_agg(column_name, '|' ORDER BY column_index) AS columns
        FROM duckdb_columns() WHERE table_name = 'lineitem'""",
    "source_load_reload": """SELECT pass, o_orderstatus, count(*)::BIGINT AS n
        FROM orders, (VALUES ('load'), ('reload')) AS p(pass) GROUP BY ALL""",
    "sink_processed": "SELECT * FROM orders",
}
