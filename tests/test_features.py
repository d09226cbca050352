import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import cluster, features, split


def test_roles_and_exclusions(spark):
    df = spark.createDataFrame([(1, "a", True, [1.0], 3, 0)],
                               "n int, s string, b boolean, v array<double>, cluster int, y int")
    roles = features.split_feature_roles(df, "y")
    assert roles.numeric == ["n"]
    assert roles.categorical == ["s", "b", "cluster"]
    assert list(roles.excluded) == ["v"]


def test_constant_column_and_unseen_level(spark):
    train = spark.createDataFrame([(1, 5.0, "a", True), (2, 5.0, "b", False), (3, None, None, None)],
                                  "y int, x double, s string, b boolean")
    model = features.fit_features(train, "y")
    assert model.feature_names == ["x", "s___MISSING__", "s_a", "s_b", "b_False", "b_True",
                                   "b___MISSING__"]
    test = spark.createDataFrame([(1, 7.0, "new", True)], train.schema)
    values = model.transform(test).select(vector_to_array("features").alias("v")).first().v
    assert values == [2.0, 0, 0, 0, 0, 1.0, 0]
    assert features.feature_names(model, 2) == ["feature_0", "feature_1"]


def test_median_imputed_before_scaling(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (10.0, 1), (None, 1)], "x double, y int")
    model = features.fit_features(df, "y")
    filled = np.array([1.0, 2.0, 10.0, 2.0])
    found = [r.v[0] for r in model.transform(df).select(vector_to_array("features").alias("v"))
             .collect()]
    assert np.allclose(found, (filled - filled.mean()) / filled.std())


def test_no_feature_raises(spark):
    with pytest.raises(ValueError, match="no numeric or categorical"):
        features.fit_features(spark.createDataFrame([([1.0], 1)], "v array<double>, y int"), "y")


def test_level_limit_reports_column(spark):
    df = spark.createDataFrame([(i, str(i), i % 2) for i in range(50)], "n int, s string, y int")
    model = features.fit_features(df, "y", max_levels=10)
    assert model.feature_names == ["n"] and "s" in model.roles.excluded


@pytest.mark.parametrize("n,k", [(1, None), (3, 2), (20, 2), (57, 5), (100, 10), (5000, 10)])
def test_choose_k(spark, n, k):
    assert cluster.choose_k(n) == k
    rule = spark.range(1).select(cluster.choose_k_rule(F.lit(n)).cast("int").alias("k")).first().k
    assert rule == k


def blobs(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(rng.normal() + 40 * (i % 3)), float(rng.normal() - 30 * (i % 3)))
            for i in range(90)]
    return spark.createDataFrame(rows, "id int, a double, b double")


def test_kmeans_nearest_centre_and_restarts(spark):
    df = blobs(spark)
    one = cluster.kmeans_fit(df, ["a", "b"], 3, ["id"], restarts=1)
    best = cluster.kmeans_fit(df, ["a", "b"], 3, ["id"], restarts=4)
    assert best.cost <= one.cost + 1e-9
    centres = np.array(best.centres)
    for r in best.transform(df).collect():
        z = np.array([(r.a - best.scaling.centre["a"]) / best.scaling.spread["a"],
                      (r.b - best.scaling.centre["b"]) / best.scaling.spread["b"]])
        assert r.cluster == ((centres - z) ** 2).sum(axis=1).argmin()


def sequential_lloyd(points, centres, max_iter, tol):
    """One start, one point after the other."""
    for _ in range(max_iter):
        own = [min(range(len(centres)), key=lambda c: (((p - centres[c]) ** 2).sum(), c))
               for p in points]
        moved = np.array([np.mean([p for p, o in zip(points, own) if o == c], axis=0)
                          if c in own else centres[c] for c in range(len(centres))])
        done = np.sqrt(((moved - centres) ** 2).sum(axis=1)).max() <= tol
        centres = moved
        if done:
            break
    return centres, sum(((centres - p) ** 2).sum(axis=1).min() for p in points)


def test_starts_in_one_scan_equal_starts_one_by_one(spark, monkeypatch):
    points = np.random.default_rng(3).normal(size=(200, 3)).round(2)
    df = spark.createDataFrame([tuple(map(float, p)) for p in points],
                               "x double, y double, z double").repartition(5)
    sets = np.array([cluster.spread_centres(points, 4, s) for s in range(5)])
    sets[4, 3] = 99.0  # a centre that no row is near
    live = []
    scan = cluster._scan
    monkeypatch.setattr(cluster, "_scan", lambda v, s: live.append(len(s)) or scan(v, s))
    found, costs = cluster.lloyd(df, sets, 12, 1e-4)
    for s, start in enumerate(sets):
        centres, cost = sequential_lloyd(points, start, 12, 1e-4)
        assert np.allclose(found[s], centres, atol=1e-9)
        assert costs[s] == pytest.approx(cost, rel=1e-9)
    assert found[4, 3].tolist() == [99.0] * 3
    assert len(live) <= 13 and live[0] == live[-1] == 5 and sorted(live[:-1])[::-1] == live[:-1]


def test_starting_centres_of_equal_rows(spark):
    assert cluster.spread_centres(np.ones((5, 2)), 3, 1).tolist() == [[1.0, 1.0]] * 3
    df = spark.createDataFrame([(i, 2.0, 5.0) for i in range(9)], "id int, a double, b double")
    model = cluster.kmeans_fit(df, ["a", "b"], 3, ["id"], restarts=2)
    assert model.cost == 0 and {r.cluster for r in model.transform(df).collect()} == {0}


def test_kmeans_does_not_depend_on_partitioning(spark):
    df = blobs(spark)
    found = [sorted((r.id, r.cluster) for r in cluster.kmeans_fit(
        df.repartition(n), ["a", "b"], 4, ["id"], restarts=2).transform(df).collect())
        for n in (1, 8)]
    assert found[0] == found[1]


def test_too_few_rows_skip_clustering(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, a double")
    out, model = cluster.kmeans_assign(df, ["a"], ["id"])
    assert model is None and out.columns == ["id", "a"]


def test_split_is_exact_and_independent_of_partitioning(spark):
    df = spark.range(1003).withColumn("y", F.when(F.col("id") < 700, "hot")
                                      .when(F.col("id") < 990, "mid").otherwise("rare"))
    tests = [sorted(r.id for r in split.stratified_split(d, "y", ["id"]).where("is_test")
                    .collect()) for d in (df.repartition(1), df.repartition(8))]
    assert tests[0] == tests[1] and len(tests[0]) == 201
    counts = {r.y: r["count"] for r in split.stratified_split(df, "y", ["id"]).where("is_test")
              .groupBy("y").count().collect()}
    assert counts == {"hot": 140, "mid": 58, "rare": 3}


def test_tiny_class_means_plain_split(spark):
    df = spark.range(50).withColumn("y", (F.col("id") == 0).cast("int"))
    cuts = split.fit_split(df, "y", ["id"])
    assert not cuts.stratified
    assert cuts.transform(df).where("is_test").count() == 10


def test_sample_is_stable(spark):
    df = spark.range(500)
    samples = [sorted(r.id for r in split.sample_rows(d, 20, ["id"]).collect())
               for d in (df.repartition(1), df.repartition(9))]
    assert samples[0] == samples[1] and len(samples[0]) == 20
