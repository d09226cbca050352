"""Cleaning, JSON text and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import GAPPY_LINES_SQL, LINE_KEYS, gappy_lines, table
from tabwright.config import DATE_FORMATS
from tabwright.functions.texts import json_scalar, parse_datetime
from tabwright.operators import clean, datetimes, jsoncol, profile


def high_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_high_missing_columns(gappy_lines(spark, sf_dir), 0.8)


def all_missing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_all_missing_rows(
        gappy_lines(spark, sf_dir).select("quantity", "price", "tax", "flag"))


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_duplicate_rows(gappy_lines(spark, sf_dir).select(
        "l_linenumber", F.nanvl("quantity", F.lit(None).cast("double")).alias("quantity"), "flag"))


def duplicate_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, with those of a length that ends in 0 read twice."""
    rows = table(spark, sf_dir, "documents").select("source", "lang", "n_chars", "text")
    return clean.drop_duplicate_rows(rows.unionAll(rows.where(F.col("n_chars") % 10 == 0)))


def empty_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = gappy_lines(spark, sf_dir).select(
        *LINE_KEYS, "quantity", F.expr("CASE WHEN l_linenumber < 0 THEN l_suppkey END")
        .alias("never"), F.expr("CASE WHEN l_linenumber > 0 THEN double('NaN') END")
        .alias("never_number"))
    cleaned = clean.drop_empty_columns(lines)
    return cleaned.withColumn("quantity", F.nanvl("quantity", F.lit(None).cast("double")))


def missing_target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_missing_target_rows(
        gappy_lines(spark, sf_dir).select(*LINE_KEYS, "quantity"), "quantity")


def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_report(gappy_lines(spark, sf_dir)).select(
        "column_name", F.round("missing_ratio", 9).alias("missing_ratio"))


def json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties in several spellings, by event type."""
    return table(spark, sf_dir, "events").select("event_id", "event_type", F.expr("""
        CASE event_type WHEN 'click' THEN props
                        WHEN 'view' THEN replace(props, '"', "'")
                        WHEN 'error' THEN concat('  ', replace(props, '}', ',}'))
                        WHEN 'purchase' THEN concat('{', props)
                        ELSE concat('{"a": 1, "name": "', event_type, '"}') END""").alias("body"))


JSON_TEXTS_SQL = """(SELECT event_id, event_type,
    CASE event_type WHEN 'click' THEN props
                    WHEN 'view' THEN replace(props, '"', '''')
                    WHEN 'error' THEN '  ' || replace(props, '}', ',}')
                    WHEN 'purchase' THEN '{' || props
                    ELSE '{"a": 1, "name": "' || event_type || '"}' END AS body FROM events)"""


def json_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsoncol.json_like_report(
        json_texts(spark, sf_dir).withColumn("padded", F.concat(F.lit(" \t"), "body")))


def json_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_texts(spark, sf_dir).select("event_id", json_scalar(F.col("body")).alias("scalar"))


def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsoncol.flatten_json_columns(
        table(spark, sf_dir, "events").select("event_id", "event_type", "props"))


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'yyyy-MM-dd') AS iso_text",
        "date_format(o_orderdate, 'MM/dd/yyyy') AS slash_text",
        "o_orderpriority AS word_text",
        "CASE WHEN o_orderstatus = 'P' THEN date_format(o_orderdate, 'yyyy-MM-dd') "
        "ELSE o_orderpriority END AS half_text",
        "CASE WHEN o_orderkey = 1 THEN 'unknown 1-1' ELSE date_format(o_orderdate, 'yyyy-MM-dd') "
        "END AS one_bad_text",
        "string(o_custkey) AS digits_text")


DATE_TEXTS_SQL = """(SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso_text,
    strftime(o_orderdate, '%m/%d/%Y') AS slash_text, o_orderpriority AS word_text,
    CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE o_orderpriority END AS half_text,
    CASE WHEN o_orderkey = 1 THEN 'unknown 1-1' ELSE strftime(o_orderdate, '%Y-%m-%d')
         END AS one_bad_text,
    o_custkey::VARCHAR AS digits_text FROM orders)"""

DATE_TEXT_COLUMNS = ["iso_text", "slash_text", "word_text", "half_text", "one_bad_text",
                     "digits_text"]


def date_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = datetimes.probe_datetime_strings(date_texts(spark, sf_dir), DATE_TEXT_COLUMNS)
    return spark.createDataFrame([(c, c in found) for c in DATE_TEXT_COLUMNS],
                                 "column_name string, is_date boolean")


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_texts(spark, sf_dir).select("o_orderkey", *[
        parse_datetime(F.col(c), DATE_FORMATS).cast("timestamp_ntz").alias(c)
        for c in ("iso_text", "slash_text", "half_text")])


def date_features_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datetimes.extract_datetime_features(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))


def date_features_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datetimes.extract_datetime_features(
        table(spark, sf_dir, "events").select("event_id", "ts"))


def date_features_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datetimes.extract_datetime_features(
        gappy_lines(spark, sf_dir).select(*LINE_KEYS, "shipped"))


QUERIES = {
    "clean_high_missing_columns": lambda s, d: high_missing_columns(s, d).withColumn(
        "quantity", F.nanvl("quantity", F.lit(None).cast("double"))),
    "clean_all_missing_rows": lambda s, d: all_missing_rows(s, d).withColumn(
        "quantity", F.nanvl("quantity", F.lit(None).cast("double"))),
    "clean_duplicate_rows": duplicate_rows,
    "clean_duplicate_wide_rows": duplicate_wide_rows,
    "clean_empty_columns": empty_columns,
    "clean_missing_target_rows": missing_target_rows,
    "clean_missing_report": missing_report,
    "json_like_columns": json_like,
    "json_name_or_first": json_scalars,
    "json_flatten_columns": json_flatten,
    "date_probe_strings": date_probe,
    "date_parse_text": date_parse,
    "date_features_orders": date_features_orders,
    "date_features_events": date_features_events,
    "date_features_imputed": date_features_imputed,
}


def _probe_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, coalesce(bool_and(
        try_strptime(v, ['%Y-%m-%d', '%m/%d/%Y']) IS NOT NULL), false) AS is_date
        FROM (SELECT {column} AS v FROM {DATE_TEXTS_SQL} WHERE {column} IS NOT NULL
              ORDER BY md5('42:' || {column}) LIMIT 50)"""


def _parts_sql(key: str, column: str, source: str, clock: bool) -> str:
    parts = {"year": f"year({column})", "month": f"month({column})", "day": f"day({column})",
             "dayofweek": f"isodow({column}) - 1"}
    if clock:
        parts.update(hour=f"hour({column})", minute=f"minute({column})")
    fields = ", ".join(f"({e})::INTEGER AS {column}_{p}" for p, e in parts.items())
    return f"SELECT {key}, {fields} FROM {source}"


_IMPUTED_PARTS = {"year": "year(shipped)", "month": "month(shipped)", "day": "day(shipped)",
                  "dayofweek": "isodow(shipped) - 1"}

SQL = {
    "clean_high_missing_columns": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        quantity, price, flag, shipped FROM {GAPPY_LINES_SQL}""",
    "clean_all_missing_rows": f"""SELECT quantity, price, tax, flag FROM {GAPPY_LINES_SQL}
        WHERE coalesce(quantity, price, tax) IS NOT NULL OR flag IS NOT NULL""",
    "clean_duplicate_wide_rows": "SELECT DISTINCT source, lang, n_chars, text FROM documents",
    "clean_duplicate_rows": f"""SELECT DISTINCT l_linenumber, quantity, flag
        FROM {GAPPY_LINES_SQL}""",
    "clean_empty_columns": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, quantity
        FROM {GAPPY_LINES_SQL}""",
    "clean_missing_target_rows": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        quantity FROM {GAPPY_LINES_SQL} WHERE quantity IS NOT NULL""",
    "clean_missing_report": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(({c} IS NULL)::INTEGER::DOUBLE), 9) "
        f"AS missing_ratio FROM {GAPPY_LINES_SQL}"
        for c in [*LINE_KEYS, "quantity", "price", "tax", "flag", "shipped"]),
    "json_like_columns": f"""SELECT 'event_type' AS column_name,
        bool_or(starts_with(trim(event_type), '{{')) AS is_json FROM events
        UNION ALL SELECT 'body', bool_or(starts_with(trim(body), '{{')) FROM {JSON_TEXTS_SQL}
        UNION ALL SELECT 'padded', bool_or(starts_with(trim(body), '{{')) FROM {JSON_TEXTS_SQL}""",
    "json_name_or_first": f"""SELECT event_id, CASE WHEN json_valid(fixed)
            THEN coalesce(json_extract_string(fixed, '$.name'),
                          json_extract_string(fixed, '$."' || json_keys(fixed)[1] || '"'))
            ELSE trim(body) END AS scalar
        FROM (SELECT *, regexp_replace(replace(body, '''', '"'), ',\\}}$', '}}') AS fixed
              FROM {JSON_TEXTS_SQL})""",
    "json_flatten_columns": """SELECT event_id, event_type,
        json_extract_string(props, '$.k')::DOUBLE AS props FROM events""",
    "date_probe_strings": "\nUNION ALL ".join(_probe_sql(c) for c in DATE_TEXT_COLUMNS),
    "date_parse_text": f"""SELECT o_orderkey,
        try_strptime(iso_text, '%Y-%m-%d')::TIMESTAMP AS iso_text,
        try_strptime(slash_text, '%m/%d/%Y')::TIMESTAMP AS slash_text,
        try_strptime(half_text, '%Y-%m-%d')::TIMESTAMP AS half_text FROM {DATE_TEXTS_SQL}""",
    "date_features_orders": _parts_sql("o_orderkey", "o_orderdate", "orders", False),
    "date_features_events": _parts_sql("event_id", "ts", "events", True),
    "date_features_imputed": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {', '.join(
        f"coalesce(({e})::DOUBLE, (SELECT median({e}) FROM {GAPPY_LINES_SQL})::DOUBLE) "
        f"AS shipped_{p}" for p, e in _IMPUTED_PARTS.items())} FROM {GAPPY_LINES_SQL}""",
}
