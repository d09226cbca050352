"""Column profiles, task types, target choice and label codes, over all test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import table
from tabwright.config import COMMON_TARGET_NAMES, ID_NAME_PARTS
from tabwright.operators import datetimes, jsoncol, profile, target

# Columns after dates are expanded and JSON text is flattened: name -> (SQL expression, numeric).
WHOLE, REAL, TEXT = "whole", "real", "text"


def _dated(column: str, clock: bool = False) -> dict[str, tuple[str, str]]:
    parts = {"year": f"year({column})", "month": f"month({column})", "day": f"day({column})",
             "dayofweek": f"isodow({column}) - 1"}
    if clock:
        parts.update(hour=f"hour({column})", minute=f"minute({column})")
    return {f"{column}_{p}": (e, WHOLE) for p, e in parts.items()}


def _plain(**kinds: str) -> dict[str, tuple[str, str]]:
    return {c: (c, k) for c, k in kinds.items()}


COLUMNS = {
    "region": _plain(r_regionkey=WHOLE, r_name=TEXT),
    "nation": _plain(n_nationkey=WHOLE, n_name=TEXT, n_regionkey=WHOLE),
    "customer": _plain(c_custkey=WHOLE, c_name=TEXT, c_nationkey=WHOLE, c_acctbal=REAL,
                       c_mktsegment=TEXT),
    "supplier": _plain(s_suppkey=WHOLE, s_name=TEXT, s_nationkey=WHOLE, s_acctbal=REAL),
    "part": _plain(p_partkey=WHOLE, p_name=TEXT, p_brand=TEXT, p_type=TEXT, p_size=WHOLE,
                   p_retailprice=REAL),
    "orders": {**_plain(o_orderkey=WHOLE, o_custkey=WHOLE, o_orderstatus=TEXT, o_totalprice=REAL,
                        o_orderpriority=TEXT), **_dated("o_orderdate")},
    "lineitem": {**_plain(l_orderkey=WHOLE, l_partkey=WHOLE, l_suppkey=WHOLE, l_linenumber=WHOLE,
                          l_quantity=REAL, l_extendedprice=REAL, l_discount=REAL, l_tax=REAL,
                          l_returnflag=TEXT, l_linestatus=TEXT), **_dated("l_shipdate")},
    "events": {**_plain(event_id=WHOLE, user_id=WHOLE, event_type=TEXT, value=REAL),
               "props": ("json_extract_string(props, '$.k')::DOUBLE", REAL), **_dated("ts", True)},
    "documents": _plain(doc_id=WHOLE, text=TEXT, lang=TEXT, source=TEXT, n_chars=WHOLE),
    "pages": _plain(page_id=WHOLE, url=TEXT, html=TEXT),
    "benchmark": _plain(item_id=WHOLE, text=TEXT),
    "labels": _plain(doc_id=WHOLE, quality=WHOLE, toxic=WHOLE),
    "conversations": _plain(conv_id=WHOLE, turn=WHOLE, role=TEXT, text=TEXT),
}


def expanded(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = table(spark, sf_dir, name)
    if name == "events":
        df = jsoncol.flatten_json_columns(df)
    return datetimes.extract_datetime_features(df)


def _over(names, build) -> "callable":
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        parts = [build(expanded(spark, sf_dir, n)).withColumn("table_name", F.lit(n))
                 for n in names]
        return reduce(DataFrame.unionByName, parts)
    return query


def _ranked(df: DataFrame) -> DataFrame:
    ranked = target.rank_targets(profile.profile_columns(df))
    return ranked.select("target_rank", "column_name", "task_type",
                         F.round("priority", 9).alias("priority"), "path")


def _candidates(df: DataFrame) -> DataFrame:
    return target.target_candidates(profile.profile_columns(df)).select("column_name", "path")


def _profile(df: DataFrame) -> DataFrame:
    return profile.profile_columns(df).select(
        "ordinal", "column_name", "row_count", "missing", "distinct_count",
        F.round("distinct_ratio", 9).alias("distinct_ratio"), "is_integral")


def _named(df: DataFrame) -> DataFrame:
    return target.match_common_target_name(profile.profile_columns(df)).select(
        "column_name", "name_rank")


def chosen_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for name in COLUMNS:
        df = expanded(spark, sf_dir, name)
        best = target.resolve_target(df)
        rows.append((name, best, target.detect_task_type(df, best)))
    return spark.createDataFrame(rows, "table_name string, target string, task_type string")


def label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded, encoding = target.label_encode(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")
    return target.label_decode(encoded, encoding, ["label"]).select(
        "o_orderkey", "label", "label_Original")


WIDE_TABLES = ["lineitem", "orders", "events", "customer", "part", "documents"]

def text_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every different text is a class of its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded, encoding = target.label_encode(docs, "text")
    decoded = target.label_decode(encoded, encoding, ["label"])
    return decoded.select("doc_id", "label", F.length("label_Original").alias("n_chars"))


QUERIES = {
    "profile_columns": _over(WIDE_TABLES, _profile),
    "profile_plottable": _over(["lineitem", "customer", "pages"], lambda df: overview_columns(df)),
    "target_task_types": _over(WIDE_TABLES, lambda df: target.task_types(df).select(
        "column_name", "task_type")),
    "target_candidates": _over(list(COLUMNS), _candidates),
    "target_common_names": _over(["labels", "documents", "conversations"], _named),
    "target_ranking": _over(list(COLUMNS), _ranked),
    "target_choice": chosen_targets,
    "target_label_codes": label_codes,
    "target_label_codes_texts": text_codes,
}


def overview_columns(df: DataFrame) -> DataFrame:
    return profile.plottable_columns(df, 1000)


def _profile_sql(names) -> str:
    """One row per column: counts computed column by column."""
    parts = []
    for n in names:
        for i, (column, (expression, kind)) in enumerate(COLUMNS[n].items()):
            integral = {WHOLE: "true", TEXT: "false"}.get(
                kind, f"bool_and({expression} = floor({expression}))")
            parts.append(f"""SELECT '{n}' AS table_name, {i} AS pos, '{column}' AS column_name,
                '{kind}' AS kind, count(*)::BIGINT AS row_count,
                (count(*) - count({expression}))::BIGINT AS missing,
                count(DISTINCT {expression})::BIGINT AS distinct_count,
                {integral} AS is_integral FROM {n}""")
    return "(" + "\nUNION ALL ".join(parts) + ")"


_ID_RULE = " OR ".join(f"contains(lower(column_name), '{p}')" for p in ID_NAME_PARTS)
_ID_NAMES = ", ".join(f"'{p}'" for p in ID_NAME_PARTS)
_NAME_LIST = "[" + ", ".join(f"'{n}'" for n in COMMON_TARGET_NAMES) + "]"
_TASK = """CASE WHEN kind = 'text' OR distinct_count = 2 OR (distinct_count / row_count < 0.05
    AND distinct_count < 100 AND is_integral) THEN 'classification' ELSE 'regression' END"""


def _candidate_sql(names) -> str:
    return f"""(SELECT *, CASE WHEN strict THEN 'filtered' ELSE 'fallback' END AS path,
        {_TASK} AS task_type,
        nullif(list_position({_NAME_LIST}, lower(column_name)), 0)::INTEGER AS name_rank
        FROM (SELECT *, bool_or(strict) OVER (PARTITION BY table_name) AS any_strict
              FROM (SELECT *, distinct_count > 1 AND missing / row_count <= 0.5 AS usable,
                    (NOT ({_ID_RULE}) OR (lower(column_name) IN ({_ID_NAMES})
                     AND distinct_count / row_count < 0.95)) AND distinct_count < row_count
                    AND distinct_count > 1 AND missing / row_count <= 0.5 AS strict
                    FROM {_profile_sql(names)}))
        WHERE strict OR (NOT any_strict AND usable))"""


def _ranking_sql(names) -> str:
    return f"""SELECT table_name, (row_number() OVER (PARTITION BY table_name ORDER BY
            name_rank NULLS LAST, task_type, priority, pos))::INTEGER AS target_rank,
            column_name, task_type, priority, path
        FROM (SELECT *, CASE WHEN task_type = 'regression' THEN -distinct_count / row_count
                  WHEN distinct_count = 2 THEN 0.0 ELSE distinct_count / row_count END AS priority
              FROM {_candidate_sql(names)})"""


SQL = {
    "target_label_codes_texts": """SELECT doc_id, (dense_rank() OVER (ORDER BY text) - 1)::INTEGER AS label,
        length(text)::INTEGER AS n_chars FROM documents""",
    "profile_columns": f"""SELECT table_name, pos::INTEGER AS ordinal, column_name, row_count,
        missing, distinct_count, round(distinct_count / row_count, 9) AS distinct_ratio,
        is_integral FROM {_profile_sql(WIDE_TABLES)}""",
    "profile_plottable": f"""SELECT table_name, pos::INTEGER AS ordinal, column_name,
        distinct_count FROM (SELECT *, bool_or(distinct_count < 1000) OVER (PARTITION BY table_name)
            AS any_fits FROM {_profile_sql(["lineitem", "customer", "pages"])})
        WHERE distinct_count < 1000 OR NOT any_fits""",
    "target_task_types": f"""SELECT table_name, column_name, {_TASK} AS task_type
        FROM {_profile_sql(WIDE_TABLES)}""",
    "target_candidates": f"SELECT table_name, column_name, path FROM {_candidate_sql(COLUMNS)}",
    "target_common_names": f"""SELECT table_name, column_name,
        nullif(list_position({_NAME_LIST}, lower(column_name)), 0)::INTEGER AS name_rank
        FROM {_profile_sql(["labels", "documents", "conversations"])}""",
    "target_ranking": f"""SELECT table_name, target_rank, column_name, task_type,
        round(priority, 9)::DOUBLE AS priority, path FROM ({_ranking_sql(COLUMNS)})""",
    "target_choice": f"""SELECT table_name, column_name AS target, task_type
        FROM ({_ranking_sql(COLUMNS)}) WHERE target_rank = 1""",
    "target_label_codes": """SELECT o_orderkey,
        (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INTEGER AS label,
        o_orderpriority AS "label_Original" FROM orders""",
}
