"""Summaries of tables and columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.evaluation import PRICES_SQL, prices
from catalog.tables import GAPPY_LINES_SQL, LINE_KEY_SQL, LINE_KEYS, gappy_lines, table
from tabwright.functions.columns import nan_to_null
from tabwright.operators import order_stats, overview

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GAPPY = ["quantity", "price", "tax", "l_linenumber"]


def _histogram(name: str, column: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return overview.histogram(table(spark, sf_dir, name), column).select(
            "bin", F.round("bin_start", 4).alias("bin_start"),
            F.round("bin_end", 4).alias("bin_end"), "n")
    return query


def _percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles by narrowing brackets, forced by small limits."""
    lines = table(spark, sf_dir, "lineitem")
    found = order_stats.exact_percentiles(lines, NUMBERS, [0.05, 0.5, 0.95], 100, 200)
    return spark.createDataFrame([(c, *[round(v, 6) for v in values])
                                  for c, values in found.items()],
                                 "column_name string, p05 double, p50 double, p95 double")


def _describe_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [overview.describe_text(table(spark, sf_dir, n), c)
             for n, c in (("documents", "text"), ("part", "p_brand"), ("events", "event_type"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES = {
    "overview_histogram_lineitem": _histogram("lineitem", "l_extendedprice"),
    "overview_histogram_customer": _histogram("customer", "c_acctbal"),
    "overview_top_frequencies": lambda s, d: overview.top_frequencies(
        table(s, d, "part"), "p_name"),
    "overview_frequencies_text": lambda s, d: overview.top_frequencies(
        table(s, d, "documents"), "text"),
    "overview_describe_numeric": lambda s, d: overview.describe_numeric(
        table(s, d, "lineitem"), NUMBERS),
    "overview_describe_gaps": lambda s, d: overview.describe_numeric(
        nan_to_null(gappy_lines(s, d)), GAPPY),
    "overview_describe_text": _describe_text,
    "overview_percentiles": _percentiles,
    "overview_correlation": lambda s, d: overview.correlation_matrix(
        table(s, d, "lineitem"), digits=2),
    "overview_correlation_gaps": lambda s, d: overview.correlation_matrix(
        gappy_lines(s, d), GAPPY, digits=4),
    "overview_scatter_points": lambda s, d: overview.scatter_points(
        table(s, d, "lineitem"), "l_quantity", "l_extendedprice", "l_linenumber",
        key_cols=LINE_KEYS),
    "overview_scatter_sample": lambda s, d: overview.scatter_points(
        table(s, d, "lineitem"), "l_quantity", "l_extendedprice", "l_linenumber", 500, LINE_KEYS),
    "overview_predictions_sample": lambda s, d: overview.predictions_sample(
        prices(s, d), LINE_KEYS, 50),
    "overview_processed_sample": lambda s, d: overview.processed_sample(
        table(s, d, "orders"), ["o_orderkey"], 20),
}


def _histogram_sql(name: str, column: str) -> str:
    return f"""WITH b AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {name})
        SELECT bin, round(lo + bin * ((hi - lo) / 50), 4) AS bin_start,
            round(lo + (bin + 1) * ((hi - lo) / 50), 4) AS bin_end, n
        FROM (SELECT least(floor(({column} - lo) / (hi - lo) * 50), 49)::INTEGER AS bin,
                  count(*)::BIGINT AS n FROM {name}, b GROUP BY 1), b"""


def _describe_sql(columns: list[str], source: str) -> str:
    return "\nUNION ALL ".join(f"""SELECT '{c}' AS column_name, count({c})::BIGINT AS count,
        round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std,
        round(min({c})::DOUBLE, 3) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 3) AS p25,
        round(quantile_cont({c}::DOUBLE, 0.5), 3) AS p50,
        round(quantile_cont({c}::DOUBLE, 0.75), 3) AS p75,
        round(max({c})::DOUBLE, 3) AS max FROM {source}""" for c in columns)


def _correlation_sql(columns: list[str], source: str, digits: int) -> str:
    def pair(a: str, b: str) -> str:
        if a == b:
            return f"SELECT '{a}' AS column_a, '{b}' AS column_b, 1.0::DOUBLE AS correlation"
        return f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
            CASE WHEN min({a}) FILTER ({b} IS NOT NULL) < max({a}) FILTER ({b} IS NOT NULL)
                  AND min({b}) FILTER ({a} IS NOT NULL) < max({b}) FILTER ({a} IS NOT NULL)
            THEN round(corr({a}::DOUBLE, {b}::DOUBLE), {digits}) + 0.0 END AS correlation
            FROM {source}"""

    return "\nUNION ALL ".join(pair(a, b) for a in columns for b in columns)


def _text_sql(name: str, column: str) -> str:
    return f"""SELECT '{column}' AS column_name, sum(n)::BIGINT AS count,
        count(*)::BIGINT AS unique, first(v ORDER BY n DESC, v) AS top, max(n)::BIGINT AS freq
        FROM (SELECT {column} AS v, count(*) AS n FROM {name} GROUP BY 1)"""


_LINE_NUMERIC = [*LINE_KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_POINTS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS x, "
           "l_extendedprice AS y, l_linenumber::VARCHAR AS color")

SQL = {
    "overview_histogram_lineitem": _histogram_sql("lineitem", "l_extendedprice"),
    "overview_histogram_customer": _histogram_sql("customer", "c_acctbal"),
    "overview_top_frequencies": """SELECT p_name AS value, count(*)::BIGINT AS n FROM part
        GROUP BY 1 ORDER BY n DESC, value LIMIT 25""",
    "overview_frequencies_text": """SELECT text AS value, count(*)::BIGINT AS n FROM documents
        GROUP BY 1 ORDER BY n DESC, value LIMIT 25""",
    "overview_describe_numeric": _describe_sql(NUMBERS, "lineitem"),
    "overview_describe_gaps": _describe_sql(GAPPY, GAPPY_LINES_SQL),
    "overview_describe_text": "\nUNION ALL ".join(
        _text_sql(n, c) for n, c in (("documents", "text"), ("part", "p_brand"),
                                     ("events", "event_type"))),
    "overview_percentiles": "\nUNION ALL ".join(f"""SELECT '{c}' AS column_name,
        round(quantile_cont({c}, 0.05), 6) AS p05, round(quantile_cont({c}, 0.5), 6) AS p50,
        round(quantile_cont({c}, 0.95), 6) AS p95 FROM lineitem""" for c in NUMBERS),
    "overview_correlation": _correlation_sql(_LINE_NUMERIC, "lineitem", 2),
    "overview_correlation_gaps": _correlation_sql(GAPPY, GAPPY_LINES_SQL, 4),
    "overview_scatter_points": f"SELECT {_POINTS} FROM lineitem",
    "overview_scatter_sample": f"""SELECT {_POINTS} FROM lineitem
        ORDER BY md5('42:' || {LINE_KEY_SQL}) LIMIT 500""",
    "overview_predictions_sample": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        round(y, 3) AS y, round(p_rf, 3) AS p_rf, round(p_knn, 3) AS p_knn FROM {PRICES_SQL}
        ORDER BY ALL LIMIT 50""",
    "overview_processed_sample": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
}
