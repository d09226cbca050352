"""Evaluation tables on predictions that SQL can state as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import LINE_KEYS, table
from tabwright.operators import evaluate
from tabwright.operators.target import CLASSIFICATION, REGRESSION


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return flag against two threshold rules; one class is never predicted by the first."""
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.expr("CASE WHEN l_quantity > 25 THEN 'R' ELSE 'A' END").alias("p_rf"),
        F.expr("CASE WHEN l_tax > 0.04 THEN 'N' WHEN l_discount > 0.05 THEN 'R' ELSE 'A' END")
        .alias("p_knn"))


FLAGS_SQL = """(SELECT l_returnflag, CASE WHEN l_quantity > 25 THEN 'R' ELSE 'A' END AS p_rf,
    CASE WHEN l_tax > 0.04 THEN 'N' WHEN l_discount > 0.05 THEN 'R' ELSE 'A' END AS p_knn
    FROM lineitem)"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, (F.col("l_extendedprice") / 1000).alias("y"),
        (F.col("l_quantity") * 2.0).alias("p_rf"),
        (F.col("l_quantity") * 1.5 + F.col("l_tax") * 100).alias("p_knn"))


PRICES_SQL = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    l_extendedprice / 1000 AS y, l_quantity * 2.0::DOUBLE AS p_rf,
    l_quantity * 1.5::DOUBLE + l_tax * 100 AS p_knn FROM lineitem)"""


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else c
                       for c, t in df.dtypes])


QUERIES = {
    "eval_accuracy": lambda s, d: _rounded(evaluate.accuracy(flags(s, d), "l_returnflag", "p_rf")),
    "eval_class_report": lambda s, d: _rounded(evaluate.classification_report(
        flags(s, d), "l_returnflag", "p_rf")),
    "eval_confusion_matrix": lambda s, d: evaluate.confusion_matrix(
        flags(s, d), "l_returnflag", "p_rf"),
    "eval_mse": lambda s, d: _rounded(evaluate.mse(prices(s, d), "y", "p_rf"), 5),
    "eval_r2": lambda s, d: _rounded(evaluate.r2(prices(s, d), "y", "p_rf")),
    "eval_residuals": lambda s, d: _rounded(evaluate.residuals(
        prices(s, d), "y", "p_rf", LINE_KEYS)),
    "eval_mean_comparison": lambda s, d: _rounded(evaluate.mean_comparison(
        prices(s, d), "y", ["p_rf", "p_knn"])),
    "eval_trend": lambda s, d: _rounded(evaluate.actual_vs_predicted_trend(
        prices(s, d), "y", ["p_rf", "p_knn"])),
    "eval_summary_classes": lambda s, d: _rounded(evaluate.metrics_summary(
        flags(s, d), "l_returnflag", "p_rf", "p_knn", CLASSIFICATION)),
    "eval_summary_values": lambda s, d: _rounded(evaluate.metrics_summary(
        prices(s, d), "y", "p_rf", "p_knn", REGRESSION), 5),
}

_R2 = ("1 - sum((y - {p}) * (y - {p})) / (SELECT sum((y - a) * (y - a)) FROM "
       f"(SELECT y, avg(y) OVER () AS a FROM {PRICES_SQL}))")
_MSE = "avg((y - {p}) * (y - {p}))"
_PER_CLASS = f"""SELECT c,
    (SELECT count(*) FROM {FLAGS_SQL} WHERE l_returnflag = c AND p_rf = c)::DOUBLE AS hits,
    (SELECT count(*) FROM {FLAGS_SQL} WHERE p_rf = c)::DOUBLE AS called,
    (SELECT count(*) FROM {FLAGS_SQL} WHERE l_returnflag = c)::DOUBLE AS support
    FROM (SELECT DISTINCT l_returnflag AS c FROM lineitem)"""
_METRICS = f"""SELECT c, support, hits,
    CASE WHEN called = 0 THEN 0 ELSE hits / called END AS p,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r,
    CASE WHEN called + support = 0 THEN 0 ELSE 2 * hits / (called + support) END AS f
    FROM ({_PER_CLASS})"""

SQL = {
    "eval_accuracy": f"""SELECT round(avg((l_returnflag = p_rf)::INTEGER::DOUBLE), 6) AS accuracy
        FROM {FLAGS_SQL}""",
    "eval_class_report": f"""WITH m AS ({_METRICS})
        SELECT c AS class_name, round(p, 6)::DOUBLE AS precision, round(r, 6)::DOUBLE AS recall,
            round(f, 6)::DOUBLE AS f1, support FROM m
        UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6),
            round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
            round(sum(hits) / sum(support), 6) FROM m
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
            sum(support) FROM m
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6),
            round(sum(r * support) / sum(support), 6),
            round(sum(f * support) / sum(support), 6), sum(support) FROM m""",
    "eval_confusion_matrix": f"""WITH c AS (SELECT l_returnflag AS v FROM {FLAGS_SQL}
            UNION SELECT p_rf FROM {FLAGS_SQL})
        SELECT a.v AS actual, b.v AS predicted, (SELECT count(*) FROM {FLAGS_SQL}
            WHERE l_returnflag = a.v AND p_rf = b.v)::BIGINT AS n FROM c a, c b""",
    "eval_mse": f"SELECT round({_MSE.format(p='p_rf')}, 5) AS mse FROM {PRICES_SQL}",
    "eval_r2": f"SELECT round({_R2.format(p='p_rf')}, 6) AS r2 FROM {PRICES_SQL}",
    "eval_residuals": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        round(p_rf, 6) AS predicted, round(y - p_rf, 6) AS residual FROM {PRICES_SQL}""",
    "eval_mean_comparison": "\nUNION ALL ".join(f"""SELECT '{p}' AS model,
        round(avg(y), 6) AS mean_actual, round(avg({p}), 6) AS mean_predicted,
        round(avg({p}) - avg(y), 6) AS delta,
        round(min(least(y, p_rf, p_knn)) - 0.1 * (max(greatest(y, p_rf, p_knn))
              - min(least(y, p_rf, p_knn))), 6) AS axis_min,
        round(max(greatest(y, p_rf, p_knn)) + 0.1 * (max(greatest(y, p_rf, p_knn))
              - min(least(y, p_rf, p_knn))), 6) AS axis_max FROM {PRICES_SQL}"""
        for p in ("p_rf", "p_knn")),
    "eval_trend": "\nUNION ALL ".join(f"""SELECT '{p}' AS model,
        round(regr_slope({p}, y), 6) AS slope, round(regr_intercept({p}, y), 6) AS intercept
        FROM {PRICES_SQL}""" for p in ("p_rf", "p_knn")),
    "eval_summary_classes": f"""SELECT
        round(avg((l_returnflag = p_rf)::INTEGER::DOUBLE), 6) AS rf_accuracy,
        round(avg((l_returnflag = p_knn)::INTEGER::DOUBLE), 6) AS knn_accuracy
        FROM {FLAGS_SQL}""",
    "eval_summary_values": f"""SELECT round({_R2.format(p='p_rf')}, 5) AS rf_r2,
        round({_MSE.format(p='p_rf')}, 5) AS rf_mse, round({_R2.format(p='p_knn')}, 5) AS knn_r2,
        round({_MSE.format(p='p_knn')}, 5) AS knn_mse FROM {PRICES_SQL}""",
}
