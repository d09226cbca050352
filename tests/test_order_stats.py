import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import order_stats
from tabwright.operators.order_stats import exact_medians, exact_percentiles


def test_median_even_and_missing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, float("nan")), (10.0, None),
                                (None, None)], "a double, b double")
    assert exact_medians(df, ["a", "b"]) == {"a": 2.5, "b": 1.5}


def test_empty_column(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert exact_medians(df, ["a"]) == {"a": None}


@pytest.mark.parametrize("shape", ["unique", "hot", "two", "signed"])
def test_narrowed_equals_direct(spark, shape):
    rng = np.random.default_rng(3)
    values = {"unique": rng.normal(size=5000), "hot": np.where(rng.random(5000) < 0.4, 7.0,
                                                              rng.normal(size=5000) * 100),
              "two": rng.integers(0, 2, 5000).astype(float),
              "signed": np.concatenate([-rng.pareto(1, 2500), rng.pareto(1, 2501)])}[shape]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    shares = [0.0, 0.05, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_percentiles(df, ["v"], shares, direct_limit=1, bracket_limit=10)["v"]
    assert np.allclose(found, np.quantile(values, shares), rtol=1e-12, atol=0)


def test_whole_numbers(spark):
    df = spark.range(1001).withColumn("h", F.lit(3))
    assert exact_percentiles(df, ["id", "h"], [0.25, 0.5], 10, 10) == {
        "id": [250.0, 500.0], "h": [3.0, 3.0]}


def test_only_searched_columns_are_sketched(spark, monkeypatch):
    sketched = []
    sketch = order_stats._sketch
    monkeypatch.setattr(order_stats, "_sketch",
                        lambda value, shares: sketched.append(str(value)) or sketch(value, shares))
    df = spark.range(501).withColumn("few", F.col("id") % 3).withColumn("none", F.lit(None).cast("double"))
    assert exact_percentiles(df, ["few", "id", "none"], [0.5], 20, 10_000) == {
        "few": [1.0], "id": [250.0], "none": [None]}
    assert len(sketched) == 1 and "id" in sketched[0]
