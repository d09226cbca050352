import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from catalog import models
from tabwright.functions.scratch import ordered_by_key
from tabwright.operators import (evaluate, explain, features, forest, overview, split,
                                 treeshap)

NAMES = ["a", "b", "c"]


def table(spark, n=600):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3))
    rows = [(f"r{i:04d}", [float(v) for v in r], float((r[0] > 0) + (r[1] > 0.5)),
             float(3 * r[0] + r[1])) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id string, v array<double>, cls double, num double")
    return df.withColumn("features", array_to_vector("v"))


@pytest.fixture(scope="module")
def data(spark):
    return table(spark).persist()


@pytest.fixture(scope="module")
def classifier(data):
    return forest.fit_rf_classifier(data.withColumn("label", F.col("cls")), trees=5, depth=3)


@pytest.fixture(scope="module")
def regressor(data):
    return forest.fit_rf_regressor(data.withColumn("label", F.col("num")), trees=5, depth=3)


def test_classifier_beats_majority(data, classifier):
    scored = forest.predict(classifier, data)
    share = evaluate.accuracy(scored, "cls", "prediction").first().accuracy
    majority = data.groupBy("cls").count().agg(F.max("count")).first()[0] / data.count()
    assert share > majority + 0.2


def test_regressor_explains(data, regressor):
    assert evaluate.r2(forest.predict(regressor, data), "num", "prediction").first().r2 > 0.5


def outputs(model, df, key="id"):
    scored = model.transform(df)
    column = vector_to_array("probability") if hasattr(model, "numClasses") \
        else F.array("prediction")
    return {r[key]: np.array(r.o) for r in scored.select(key, column.alias("o")).collect()}


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_shapley_values_equal_brute_force(spark, data, kind, request):
    model = request.getfixturevalue(kind)
    rows, background = data.orderBy("id").limit(4), data.orderBy(F.desc("id")).limit(6)
    phi = treeshap.shap_values(model, rows, background, "id", NAMES).collect()
    found = {(r.id, r["class"], r.feature): r.phi for r in phi}
    base = {r["class"]: r.base_value for r in phi}
    real = outputs(model, rows)

    xs = {r.id: r.v for r in rows.collect()}
    zs = [r.v for r in background.collect()]
    subsets = [s for n in range(4) for s in itertools.combinations(range(3), n)]
    mixed = [(f"{i}|{j}|{k}", [x[f] if f in s else z[f] for f in range(3)])
             for i, x in xs.items() for j, z in enumerate(zs) for k, s in enumerate(subsets)]
    frame = spark.createDataFrame(mixed, "id string, v array<double>")
    scored = outputs(model, frame.withColumn("features", array_to_vector("v")))
    for i in xs:
        value = {s: np.mean([scored[f"{i}|{j}|{k}"] for j in range(len(zs))], axis=0)
                 for k, s in enumerate(subsets)}
        for f in range(3):
            expected = sum(
                math.factorial(len(s)) * math.factorial(2 - len(s)) / 6
                * (value[tuple(sorted((*s, f)))] - value[s]) for s in subsets if f not in s)
            for c in base:
                assert found[i, c, NAMES[f]] == pytest.approx(expected[c], abs=1e-9)
        for c in base:
            total = base[c] + sum(found[i, c, n] for n in NAMES)
            assert total == pytest.approx(real[i][c], abs=1e-9)


def test_importance_sums_to_one_and_marks_clusters(classifier):
    rows = explain.feature_importance(classifier, ["a", "cluster_1", "c"]).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert [r.feature for r in rows if r.is_cluster] == ["cluster_1"]


def test_pdp_feature_order(spark):
    rows = [(0, "n0", 0.1), (1, "n1", 0.3), (2, "s_x", 0.4), (3, "s___MISSING__", 0.5),
            (4, "s_1 Season", 0.45)]
    table = spark.createDataFrame(rows, "slot int, feature string, importance double")
    assert explain.select_pdp_features(table, 2, 3, ["Season"]) == [1, 0, 2]


def test_partial_dependence_flat_and_rising(data, regressor):
    out = explain.partial_dependence(regressor, data.limit(100), [0, 2], NAMES, points=12)
    by = {}
    for r in out.orderBy("feature", "grid_value").collect():
        by.setdefault(r.feature, []).append(r.average)
    assert len(by["a"]) == 12 and all(x <= y + 1e-9 for x, y in zip(by["a"], by["a"][1:]))
    assert max(by["c"]) - min(by["c"]) < 0.2 * (max(by["a"]) - min(by["a"]))


def test_tree_table(classifier):
    rows = explain.tree_table(classifier, NAMES, 0, 3).collect()
    by = {r.node: r for r in rows}
    assert by[0].depth == 0 and len(rows) == len(by) <= 15
    for r in rows:
        if r.left is not None and r.depth < 3:
            assert by[r.left].depth == by[r.right].depth == r.depth + 1
            assert by[r.left].row_count + by[r.right].row_count == r.row_count


def test_report_with_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (2, 1)], "y int, p int")
    rows = {r.class_name: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert (rows["2"].precision, rows["2"].recall, rows["2"].support) == (0.0, 0.0, 1.0)
    assert rows["accuracy"].f1 == 0.5
    grid = evaluate.confusion_matrix(df, "y", "p")
    assert grid.count() == 9 and grid.agg(F.sum("n")).first()[0] == 4


def test_correlation_with_gaps_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 6.5, 5.0),
                                (float("nan"), 1.0, 5.0), (4.0, 7.0, 5.0)],
                               "a double, b double, k double")
    got = {(r.column_a, r.column_b): r.correlation
           for r in overview.correlation_matrix(df, digits=6).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 6.5, 7])[0, 1], abs=1e-6)
    assert got["a", "a"] == 1.0 and got["a", "k"] is None


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    assert [(r.bin, r.n) for r in overview.histogram(df, "v").collect()] == [(0, 2)]


def counted_rows(spark, rows, column):
    """The rows, and a counter of how often any of them is computed."""
    counter = spark.sparkContext.accumulator(0)

    def count(value):
        counter.add(1)
        return value

    return rows.withColumn(column, F.udf(count, "double")(column)), counter


@pytest.mark.parametrize("fit", [forest.fit_rf_classifier, forest.fit_rf_regressor])
def test_a_fit_computes_its_rows_once(spark, data, fit):
    rows, counter = counted_rows(spark, data.select("id", "features", F.col("cls").alias("label")),
                                 "label")
    fit(ordered_by_key(rows, ["id"]), trees=2, depth=2)
    assert counter.value == data.count()


def test_sampled_vectors_leave_the_rows_alone(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("row_id"),
                                   F.col("id").cast("double").alias("a"),
                                   F.lit(1.0).alias("label"))
    step = features.fit_features(rows, "label", ["row_id", "label"])
    rows, counter = counted_rows(spark, rows, "a")
    sample = models.sampled_vectors(step, rows, 7)
    read = counter.value
    wanted = {r.row_id for r in split.sample_rows(rows.drop("a"), 7, ["row_id"]).collect()}
    assert {r.row_id for r in sample.collect()} == wanted == {r.row_id for r in sample.collect()}
    assert counter.value == read
