"""Evaluation of predictions, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import name
from tabwright.operators.target import CLASSIFICATION, LabelEncoding


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(F.avg((name(y) == name(p)).cast("double")).alias("accuracy"))


def _pair_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.groupBy(name(y).alias("actual"), name(p).alias("predicted")) \
             .agg(F.count(F.lit(1)).alias("n"))


def class_counts_table(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per class: support, predicted count and hits, from one scan of the rows."""
    sides = F.explode(F.array(
        F.struct(F.col("actual").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long")
                 .alias("called"), F.when(F.col("actual") == F.col("predicted"), F.col("n"))
                 .otherwise(0).alias("hits")),
        F.struct(F.col("predicted").alias("c"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("called"), F.lit(0).cast("long").alias("hits"))))
    return (_pair_counts(df, y, p).select(sides.alias("s")).select("s.*")
            .groupBy("c").agg(F.sum("support").alias("support"), F.sum("called").alias("called"),
                              F.sum("hits").alias("hits")))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom != 0, top / bottom).otherwise(0.0)


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro and weighted average.

    The accuracy row repeats the accuracy in every column, as a table made from a scalar does.
    """
    classes = (class_counts_table(df, y, p)
               .withColumn("precision", _ratio(F.col("hits"), F.col("called")))
               .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
               .withColumn("f1", _ratio(2 * F.col("hits"), F.col("called") + F.col("support"))))
    kinds = F.explode(F.array(
        F.struct(F.lit("class").alias("kind"), F.col("c").cast("string").alias("class_name")),
        *[F.struct(F.lit(k).alias("kind"), F.lit(k).alias("class_name"))
          for k in ("accuracy", "macro avg", "weighted avg")]))
    sums = (classes.withColumn("k", kinds).groupBy("k.kind", "k.class_name").agg(
        F.sum("hits").alias("hits"), F.sum("support").alias("support"),
        *[F.avg(m).alias(f"{m}_macro") for m in ("precision", "recall", "f1")],
        *[F.sum(F.col(m) * F.col("support")).alias(f"{m}_sum")
          for m in ("precision", "recall", "f1")]))
    share = _ratio(F.col("hits"), F.col("support"))

    def value(metric: str) -> Column:
        return (F.when(F.col("kind") == "accuracy", share)
                .when(F.col("kind") == "weighted avg",
                      _ratio(F.col(f"{metric}_sum"), F.col("support")))
                .otherwise(F.col(f"{metric}_macro")).alias(metric))

    return sums.select("class_name", value("precision"), value("recall"), value("f1"),
                       F.when(F.col("kind") == "accuracy", share)
                       .otherwise(F.col("support").cast("double")).alias("support"))


def confusion_matrix(df: DataFrame, y: str, p: str) -> DataFrame:
    """Counts of every actual/predicted pair of classes, zeros included.

    The rows are counted once. The grid is made from the counts, one row per class pair.
    """
    counts = _pair_counts(df, y, p)
    cells = (counts.groupBy("actual").agg(
        F.map_from_entries(F.collect_list(F.struct("predicted", "n"))).alias("found"),
        F.collect_list("predicted").alias("called")))
    # One entry per class: `called` and `everyone` are as long as the class list.
    everyone = cells.agg(F.array_sort(F.array_distinct(F.concat(
        F.collect_set("actual"), F.flatten(F.collect_list("called"))))).alias("classes"))
    classes = everyone.select(F.explode("classes").alias("actual"), "classes")
    return (classes.join(cells.select("actual", "found"), "actual", "left")
            .select("actual", "found", F.explode("classes").alias("predicted"))
            .select("actual", "predicted",
                    F.coalesce(F.try_element_at("found", F.col("predicted")), F.lit(0))
                    .cast("long").alias("n")))


def _squared_error(y: str, p: str) -> Column:
    return (name(y).cast("double") - name(p).cast("double")) ** 2


def mse(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(F.avg(_squared_error(y, p)).alias("mse"))


def _r2(y: str, p: str) -> Column:
    """1 - SSE/SST from sums of one pass; SST is rows times the population variance."""
    return 1 - F.sum(_squared_error(y, p)) / (F.var_pop(name(y).cast("double"))
                                              * F.count(name(y)))


def r2(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(_r2(y, p).alias("r2"))


def residuals(df: DataFrame, y: str, p: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[name(c) for c in keep], name(p).alias("predicted"),
                     (name(y) - name(p)).alias("residual"))


def mean_comparison(df: DataFrame, y: str, predictions: Sequence[str]) -> DataFrame:
    """Mean actual and mean of each prediction, their difference, and a common padded axis."""
    columns = [y, *predictions]
    row = df.agg(*[F.avg(name(c)).alias(f"m{i}") for i, c in enumerate(columns)],
                 F.min(F.least(*[name(c) for c in columns]) if len(columns) > 1
                       else name(y)).alias("lo"),
                 F.max(F.greatest(*[name(c) for c in columns]) if len(columns) > 1
                       else name(y)).alias("hi"))
    pad = (F.col("hi") - F.col("lo")) * 0.1
    models = F.inline(F.array(*[
        F.struct(F.lit(p).alias("model"), F.col("m0").alias("mean_actual"),
                 F.col(f"m{i}").alias("mean_predicted"),
                 (F.col(f"m{i}") - F.col("m0")).alias("delta"),
                 (F.col("lo") - pad).alias("axis_min"), (F.col("hi") + pad).alias("axis_max"))
        for i, p in enumerate(predictions, start=1)]))
    return row.select(models)


def actual_vs_predicted_trend(df: DataFrame, y: str, predictions: Sequence[str]) -> DataFrame:
    """Least-squares line of each prediction on the actual value."""
    row = df.agg(*[m for i, p in enumerate(predictions) for m in (
        F.regr_slope(name(p).cast("double"), name(y).cast("double")).alias(f"s{i}"),
        F.regr_intercept(name(p).cast("double"), name(y).cast("double")).alias(f"c{i}"))])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(p).alias("model"), F.col(f"s{i}").alias("slope"),
                 F.col(f"c{i}").alias("intercept")) for i, p in enumerate(predictions)])))


def metrics_summary(df: DataFrame, y: str, rf: str, knn: str, task_type: str) -> DataFrame:
    """One row with the headline numbers of both models, from one pass."""
    if task_type == CLASSIFICATION:
        return df.agg(F.avg((name(y) == name(rf)).cast("double")).alias("rf_accuracy"),
                      F.avg((name(y) == name(knn)).cast("double")).alias("knn_accuracy"))
    return df.agg(_r2(y, rf).alias("rf_r2"), F.avg(_squared_error(y, rf)).alias("rf_mse"),
                  _r2(y, knn).alias("knn_r2"), F.avg(_squared_error(y, knn)).alias("knn_mse"))


def predictions_table(rf: DataFrame, knn: DataFrame, key: str, encoding: LabelEncoding,
                      y: str = "label") -> DataFrame:
    """Actual value and both predictions per test row, with class texts where there are any."""
    both = (rf.select(key, name(y).alias("Actual"), F.col("prediction").alias("Predicted_RF"))
            .join(knn.select(key, F.col("prediction").alias("Predicted_KNN")), key))
    columns = ["Actual", "Predicted_RF", "Predicted_KNN"]
    if not encoding.coded:
        return both
    coded = both.withColumns({c: F.col(c).cast("int") for c in columns})
    return encoding.decode(coded, {c: f"{c}_Original" for c in columns})
