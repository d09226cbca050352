"""Random forests: fit, predict, and the fitted trees as a table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.scratch import scratch_path
from tabwright.operators.target import CLASSIFICATION

ForestModel = RandomForestClassificationModel | RandomForestRegressionModel


def _fit(forest: Estimator, df: DataFrame, weight_col: str | None = None) -> ForestModel:
    """Fit on a copy of the rows on the executors' disks.

    Spark's forest runs over its input several times before it keeps it binned; each run would
    shuffle and sort ordered rows again. The copy keeps their partitions and order.
    """
    rows = df.select("features", "label", *([weight_col] if weight_col else []))
    rows.persist(StorageLevel.DISK_ONLY)
    try:
        return forest.fit(rows)
    finally:
        rows.unpersist()


def fit_rf_classifier(df: DataFrame, trees: int = 100, depth: int = 10, bins: int = 32,
                      seed: int = 42, weight_col: str | None = None,
                      bootstrap: bool = True) -> ForestModel:
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees,
                                    maxDepth=depth, maxBins=bins, seed=seed, bootstrap=bootstrap,
                                    maxMemoryInMB=1024, cacheNodeIds=depth > 12)
    if weight_col:
        forest = forest.setWeightCol(weight_col)
    return _fit(forest, df, weight_col)


def fit_rf_regressor(df: DataFrame, trees: int = 100, depth: int = 10, bins: int = 32,
                     seed: int = 42, bootstrap: bool = True) -> ForestModel:
    forest = RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=trees,
                                   maxDepth=depth, maxBins=bins, seed=seed, bootstrap=bootstrap,
                                   featureSubsetStrategy="all", maxMemoryInMB=1024,
                                   cacheNodeIds=depth > 12)
    return _fit(forest, df)


def fit_forest(df: DataFrame, task_type: str, trees: int = 100, depth: int = 10, bins: int = 32,
               seed: int = 42, weight_col: str | None = None) -> ForestModel:
    """``df`` holds ``features`` and ``label``; weights are used for classification only."""
    if task_type == CLASSIFICATION:
        return fit_rf_classifier(df, trees, depth, bins, seed, weight_col)
    return fit_rf_regressor(df, trees, depth, bins, seed)


def predict(model: ForestModel, df: DataFrame, output: str = "prediction") -> DataFrame:
    """Adds the prediction; columns the model adds besides it are left out."""
    scored = model.transform(df)
    return scored.select(*[c for c in df.columns if c != output],
                         F.col("prediction").alias(output))


def node_table(model: ForestModel) -> DataFrame:
    """All nodes of the forest, one row each, read back from the saved model.

    A two-level (0/1) feature may be split by level; it is shown as a threshold at one half, with
    the children swapped where the split sends level one to the left.
    """
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "forest")
    model.write().save(path)
    split, inner = F.col("split"), F.col("leftChild") >= 0
    by_level = inner & (split["numCategories"] > 0)
    first = F.get(split["leftCategoriesOrThreshold"], F.lit(0))
    swapped = by_level & (first == 1.0)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), "prediction", "impurity",
        F.col("impurityStats").alias("stats"), F.col("rawCount").alias("row_count"), "gain",
        F.when(swapped, F.col("rightChild")).otherwise(F.col("leftChild")).alias("left"),
        F.when(swapped, F.col("leftChild")).otherwise(F.col("rightChild")).alias("right"),
        split["featureIndex"].alias("feature"),
        F.when(by_level, F.lit(0.5)).when(inner, first).alias("threshold"))


def classes_of(model: ForestModel) -> int:
    return getattr(model, "numClasses", 1)


def forest_nodes(model: ForestModel) -> DataFrame:
    """Node table with the training weight of a node (``cover``) and its value per class: class
    shares, or the mean for regression."""
    classified = classes_of(model) > 1
    weight = F.aggregate("stats", F.lit(0.0), lambda s, x: s + x) if classified \
        else F.get("stats", F.lit(0))
    value = F.transform("stats", lambda x: x / weight) if classified \
        else F.array(F.col("prediction"))
    return node_table(model).select("tree", "node", "left", "right", "feature", "threshold",
                                    weight.alias("cover"), value.alias("value"))
