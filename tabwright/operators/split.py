"""Seeded train/test split, class weights and bounded samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.columns import hash_order, name, row_key
from tabwright.functions.scratch import materialise

# Tables of at most this many rows (a class and a hash each) are small enough to broadcast.
BROADCAST_ROWS = 100_000

# Hex digits of the hash that form the rank histogram: 65,536 buckets per class.
PREFIX_DIGITS = 4


def can_stratify(class_counts: DataFrame) -> bool:
    """More than one class and no class with a single row."""
    row = class_counts.agg(F.count(F.lit(1)).alias("n"), F.min("n").alias("least")).first()
    return row.n > 1 and row.least >= 2


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(name(label).alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


def split_quotas(counts: DataFrame, test_fraction: float) -> DataFrame:
    """Test rows per class by largest remainder; ties go to the smaller class.

    The input has one row per class, so the windows over all of it stay small.
    """
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("n").over(everything)
    test_total = F.ceil(F.col("total") * F.lit(test_fraction)).cast("long")
    shares = (counts.withColumn("total", total).withColumn("test_total", test_total)
              .withColumn("base", F.expr("(test_total * n) div total"))
              .withColumn("rest", F.expr("(test_total * n) % total")))
    by_rest = everything.orderBy(F.col("rest").desc(), F.col("stratum").asc())
    spare = F.col("test_total") - F.sum("base").over(everything)
    return (shares.withColumn("spare", spare).withColumn("place", F.row_number().over(by_rest))
            .select("stratum", "n", (F.col("base") + (F.col("place") <= F.col("spare"))
                                     .cast("long")).alias("quota")))


@dataclass
class SplitCuts:
    """Per class the largest hash that still belongs to the test side."""

    cuts: DataFrame
    small: bool
    label: str | None
    key_cols: list[str]
    seed: int
    stratified: bool

    def transform(self, df: DataFrame, output: str = "is_test") -> DataFrame:
        """Adds the test flag: a comparison of the row's hash with the cut of its class."""
        cuts = F.broadcast(self.cuts) if self.small else self.cuts
        stratum = _stratum(self.label if self.stratified else None)
        flagged = (df.withColumns({"_stratum": stratum,
                                   "_hash": hash_order(row_key(self.key_cols), self.seed)})
                   .join(cuts.withColumnRenamed("stratum", "_stratum"), "_stratum", "left"))
        return flagged.withColumn(output, F.coalesce(F.col("_hash") <= F.col("_cut"),
                                                     F.lit(False))) \
                      .drop("_stratum", "_hash", "_cut")


def _stratum(label: str | None) -> Column:
    return F.lit(0) if label is None else name(label)


def fit_split(df: DataFrame, label: str | None, key_cols: Sequence[str],
              test_fraction: float = 0.2, seed: int = 42,
              stratify: bool | None = None) -> SplitCuts:
    """Find the exact per-class cut without sorting any class.

    A histogram over hash prefixes (combined inside each task) shows in which bucket the quota
    of a class ends. Only the rows of those buckets, about one in 65,536, are ranked. A class that
    holds most of the table therefore never meets in one task.
    """
    hashed = df.select(_stratum(None if stratify is False else label).alias("stratum"),
                       hash_order(row_key(key_cols), seed).alias("h"))
    prefix = F.substring("h", 1, PREFIX_DIGITS)
    histogram = materialise(hashed.groupBy("stratum", prefix.alias("prefix"))
                            .agg(F.count(F.lit(1)).alias("m")), "split-histogram")
    counts = histogram.groupBy("stratum").agg(F.sum("m").alias("n"))
    stratified = label is not None and stratify is not False
    if stratified and not (stratify or can_stratify(counts)):
        stratified = False
        hashed = hashed.withColumn("stratum", F.lit(0))
        histogram = (histogram.groupBy(F.lit(0).alias("stratum"), "prefix")
                     .agg(F.sum("m").alias("m")))
        counts = histogram.groupBy("stratum").agg(F.sum("m").alias("n"))
    quotas = split_quotas(counts, test_fraction)
    upto = F.sum("m").over(Window.partitionBy("stratum").orderBy("prefix"))
    edges = (histogram.withColumn("upto", upto).join(quotas.select("stratum", "quota"), "stratum")
             .where((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("m") < F.col("quota")))
             .select("stratum", "prefix",
                     (F.col("quota") - F.col("upto") + F.col("m")).alias("needed")))
    # One edge row per class, written so that the row scan below can broadcast it when, and only
    # when, its size has been checked.
    edges = materialise(edges, "split-edges")
    small = edges.count() <= BROADCAST_ROWS
    edge_side = F.broadcast(edges) if small else edges
    ranked = (hashed.withColumn("prefix", prefix).join(edge_side, ["stratum", "prefix"])
              .withColumn("place", F.row_number().over(
                  Window.partitionBy("stratum", "prefix").orderBy("h"))))
    cuts = (ranked.where(F.col("place") <= F.col("needed"))
            .groupBy("stratum").agg(F.max("h").alias("_cut")))
    # Written once: every later use of the cuts reads one row per class instead of the rows.
    return SplitCuts(materialise(cuts, "split-cuts"), small, label, list(key_cols), seed, stratified)


def stratified_split(df: DataFrame, label: str | None, key_cols: Sequence[str],
                     test_fraction: float = 0.2, seed: int = 42,
                     stratify: bool | None = None) -> DataFrame:
    """The table with ``is_test``; the test side has exactly ceil(fraction * rows) rows."""
    return fit_split(df, label, key_cols, test_fraction, seed, stratify).transform(df)


def balanced_class_weights(df: DataFrame, label: str) -> DataFrame:
    """One row per class: its count and the weight rows / (classes * count)."""
    everything = Window.partitionBy(F.lit(1))
    return (df.groupBy(name(label).alias("class_value")).agg(F.count(F.lit(1)).alias("class_count"))
            .withColumn("weight", F.sum("class_count").over(everything)
                        / (F.count(F.lit(1)).over(everything) * F.col("class_count"))))


def add_class_weights(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    weights = materialise(balanced_class_weights(df, label).drop("class_count"), "weights")
    side = F.broadcast(weights) if weights.count() <= BROADCAST_ROWS else weights
    return (df.join(side.select(F.col("class_value").alias(label), F.col("weight").alias(output)),
                    label))


def sample_rows(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash of their key; each task keeps at most ``n``."""
    return (df.withColumn("_h", hash_order(row_key(key_cols), seed))
            .orderBy("_h", *[name(c) for c in key_cols]).limit(n).drop("_h"))
