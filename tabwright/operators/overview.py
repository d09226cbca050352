"""Summaries of one table or one column: the data behind the overview screens."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import is_numeric, name
from tabwright.operators.order_stats import exact_percentiles
from tabwright.operators.split import sample_rows


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins between minimum and maximum; empty bins are left out."""
    value = name(column).cast("double")
    row = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    low, high = row.lo, row.hi
    if low is None:
        raise ValueError(f"column {column} has no present value")
    if low == high:
        position = F.lit(0)
    else:
        position = F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * bins),
                           F.lit(bins - 1))
    width = (high - low) / bins
    return (df.where(value.isNotNull()).groupBy(position.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.lit(low) + F.col("bin") * width).alias("bin_start"),
                    (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_end"), "n"))


def top_frequencies(df: DataFrame, column: str, n: int = 25) -> DataFrame:
    """Value counts, most frequent first, ties by value text; the first ``n`` values."""
    return (df.where(name(column).isNotNull())
            .groupBy(name(column).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "value").limit(n))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    quartiles = exact_percentiles(df, columns, [0.25, 0.5, 0.75])
    row = df.agg(*[m for i, c in enumerate(columns) for m in (
        F.count(name(c)).alias(f"n{i}"), F.avg(name(c)).alias(f"a{i}"),
        F.stddev_samp(name(c)).alias(f"s{i}"), F.min(name(c).cast("double")).alias(f"l{i}"),
        F.max(name(c).cast("double")).alias(f"h{i}"))])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
                 F.round(F.col(f"a{i}"), 3).alias("mean"), F.round(F.col(f"s{i}"), 3).alias("std"),
                 F.round(F.col(f"l{i}"), 3).alias("min"),
                 *[F.round(F.lit(q).cast("double"), 3).alias(label)
                   for q, label in zip(quartiles[c], ("p25", "p50", "p75"))],
                 F.round(F.col(f"h{i}"), 3).alias("max"))
        for i, c in enumerate(columns)])))


def describe_text(df: DataFrame, column: str) -> DataFrame:
    """Count, distinct values, most frequent value (ties by text) and its count."""
    counted = (df.where(name(column).isNotNull())
               .groupBy(name(column).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n")))
    # The most frequent value with the smallest text: largest count first, then smallest text.
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("v")))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
                       F.count(F.lit(1)).alias("unique"), best.alias("b")).select(
        F.lit(column).alias("column_name"), "count", "unique",
        F.col("b.v").alias("top"), (-F.col("b.m")).alias("freq"))


def describe_column(df: DataFrame, column: str) -> DataFrame:
    if is_numeric(df.schema[column].dataType):
        return describe_numeric(df, [column])
    return describe_text(df, column)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType)]


def _rounded(value: Column, digits: int) -> Column:
    return F.round(value, digits) + F.lit(0.0)


def pair_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per ordered column pair, over rows where both are present: count and centred sums.

    Each task folds its batches into a few matrices whose size depends on the columns only, so
    rows never leave their task and missing values are handled pair by pair. Values are centred
    by the column mean first, which keeps the sums accurate.
    """
    present = [F.when(~F.isnan(name(c).cast("double")), name(c).cast("double"))
               for c in columns]
    means = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(present)]).first()
    centred = df.select(*[(v - F.lit(m or 0.0)).alias(f"x{i}")
                          for i, (v, m) in enumerate(zip(present, means))])
    size = len(columns)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((4, size, size))
        for batch in batches:
            values = batch.to_numpy(dtype=float)
            present = (~np.isnan(values)).astype(float)
            values = np.nan_to_num(values)
            sums += np.stack([present.T @ present, values.T @ present,
                              (values ** 2).T @ present, values.T @ values])
        i, j = np.indices((size, size))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "n": sums[0].ravel(),
                            "sx": sums[1].ravel(), "sxx": sums[2].ravel(),
                            "sy": sums[1].T.ravel(), "syy": sums[2].T.ravel(),
                            "sxy": sums[3].ravel()})

    parts = centred.mapInPandas(fold, "i int, j int, n double, sx double, sxx double, sy double, "
                                      "syy double, sxy double")
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in
                                         ("n", "sx", "sxx", "sy", "syy", "sxy")])


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None,
                       digits: int = 2) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, from the rows where both are present;
    NULL where one of them does not vary."""
    columns = numeric_columns(df) if columns is None else list(columns)
    if len(columns) < 2:
        raise ValueError("a correlation matrix needs at least two numeric columns")
    sums = pair_sums(df, columns)
    n = F.col("n")
    spread_x = F.col("sxx") - F.col("sx") ** 2 / n
    spread_y = F.col("syy") - F.col("sy") ** 2 / n
    together = F.col("sxy") - F.col("sx") * F.col("sy") / n
    value = F.when((n > 1) & (spread_x > 0) & (spread_y > 0),
                   F.least(F.lit(1.0), F.greatest(F.lit(-1.0), together
                                                  / (F.sqrt(spread_x) * F.sqrt(spread_y)))))
    labels = F.array(*[F.lit(c) for c in columns])
    return sums.select(F.get(labels, F.col("i")).alias("column_a"),
                       F.get(labels, F.col("j")).alias("column_b"),
                       _rounded(value, digits).alias("correlation"))


def scatter_points(df: DataFrame, x: str, y: str, color: str = "cluster", n: int | None = None,
                   key_cols: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Points of two columns with their colour as text; a seeded sample if ``n`` is given."""
    rows = df if n is None else sample_rows(df, n, key_cols, seed)
    return rows.select(*[name(c) for c in key_cols], name(x).alias("x"), name(y).alias("y"),
                       name(color).cast("string").alias("color"))


def first_rows(df: DataFrame, key_cols: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*[name(c) for c in key_cols]).limit(n)


def predictions_sample(df: DataFrame, key_cols: Sequence[str], n: int = 50) -> DataFrame:
    """The first rows by key, numbers rounded to three decimals."""
    rows = first_rows(df, key_cols, n)
    numbers = {c: F.round(name(c), 3) for c in numeric_columns(df) if c not in key_cols}
    return rows.withColumns(numbers) if numbers else rows


def processed_sample(df: DataFrame, key_cols: Sequence[str], n: int = 20) -> DataFrame:
    return first_rows(df, key_cols, n)
