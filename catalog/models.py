"""Forests, nearest neighbours and explanations."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.features import split_sql
from catalog.tables import LINE_KEY_SQL, LINE_KEYS, table
from tabwright.config import RunConfig
from tabwright.functions.columns import row_key
from tabwright.functions.scratch import materialise, ordered_by_key, scratch_path
from tabwright.operators import (cluster, datetimes, evaluate, explain, features, forest, knn,
                                 split, treeshap)
from tabwright.operators.target import CLASSIFICATION, REGRESSION, LabelEncoding, label_encode
from tabwright.plans.analysis import run_table
from tabwright.plans.stored import load, save
from tabwright.sources.files import read_csv
from tabwright.sources.sinks import write_cluster_profiles, write_metrics, write_predictions

TREES, DEPTH = 20, 6


def classified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a class that its columns explain, and a text key."""
    lines = table(spark, sf_dir, "lineitem").withColumn("row_id", row_key(LINE_KEYS))
    return lines.select("row_id", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                        "l_returnflag", F.expr(
                            "CASE WHEN l_quantity > 30 AND l_discount > 0.04 THEN 'big' "
                            "WHEN l_tax > 0.05 THEN 'taxed' ELSE 'plain' END").alias("kind"))


def fitted_lines(spark: SparkSession, sf_dir: str, task_type: str):
    """Split, encode and fit lineitem; returns forest, feature step, train and test rows, encoding."""
    target = "kind" if task_type == CLASSIFICATION else "l_extendedprice"
    lines = classified_lines(spark, sf_dir)
    encoding = LabelEncoding.fit(lines, target)
    flagged = materialise(split.stratified_split(
        encoding.transform(lines), "label" if task_type == CLASSIFICATION else None, ["row_id"]),
        "lines")
    model = features.fit_features(flagged.where(~F.col("is_test")), target,
                                  ["row_id", "label", "is_test"])
    train, test = flagged.where(~F.col("is_test")), flagged.where("is_test")
    # Vectors are made after the shuffle, in the one run that reads all training rows for the fit.
    fitted = forest.fit_forest(model.transform(ordered_by_key(train, ["row_id"])), task_type,
                               TREES, DEPTH)
    return fitted, model, train, test, encoding


def vectors_of(model: features.FeatureModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).select("row_id", "label", "features")


def sampled_vectors(model: features.FeatureModel, rows: DataFrame, n: int) -> DataFrame:
    """Sampled rows as vectors, written once: the explanations read them several times."""
    return vectors_of(model, materialise(split.sample_rows(rows, n, ["row_id"]), "sample"))


def forest_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, model, _, test, encoding = fitted_lines(spark, sf_dir, CLASSIFICATION)
    scored = forest.predict(fitted, vectors_of(model, test))
    texts = encoding.decode(scored, {"label": "actual_class", "prediction": "predicted_class"})
    return evaluate.confusion_matrix(texts, "actual_class", "predicted_class")


def forest_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, model, _, test, _ = fitted_lines(spark, sf_dir, REGRESSION)
    scored = forest.predict(fitted, vectors_of(model, test))
    return evaluate.mean_comparison(scored, "label", ["prediction"])


def importance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, model, *_ = fitted_lines(spark, sf_dir, CLASSIFICATION)
    return explain.feature_importance(fitted, model.feature_names)


def first_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, model, *_ = fitted_lines(spark, sf_dir, CLASSIFICATION)
    return explain.tree_table(fitted, model.feature_names)


def shap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, model, train, test, _ = fitted_lines(spark, sf_dir, CLASSIFICATION)
    return treeshap.shap_values(fitted, sampled_vectors(model, test, 500),
                                sampled_vectors(model, train, 100), "row_id",
                                model.feature_names)


def shap_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sampled row and class: do the values and the base add up to the forest's output?"""
    fitted, model, train, test, _ = fitted_lines(spark, sf_dir, CLASSIFICATION)
    rows = sampled_vectors(model, test, 500)
    phi = treeshap.shap_values(fitted, rows, sampled_vectors(model, train, 100), "row_id",
                               model.feature_names)
    total = phi.groupBy("row_id", "class").agg(
        (F.sum("phi") + F.max("base_value")).alias("total"))
    output = fitted.transform(rows).select("row_id", F.posexplode(vector_to_array("probability"))
                                           .alias("class", "output"))
    return total.join(output, ["row_id", "class"]).select(
        "row_id", "class", (F.abs(F.col("total") - F.col("output")) < 1e-9).alias("adds_up"))


def forest_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows per actual class, as the forest's confusion matrix counts them."""
    return (forest_classifier(spark, sf_dir).groupBy("actual").agg(F.sum("n").alias("n")))


def pdp_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, model, _, test, _ = fitted_lines(spark, sf_dir, CLASSIFICATION)
    slots = explain.select_pdp_features(
        explain.feature_importance(fitted, model.feature_names, None), model.numeric_slots)
    return explain.partial_dependence(fitted, sampled_vectors(model, test, 500), slots,
                                      model.feature_names)


def predictions_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual priority and two rule-made predictions, joined by key and decoded."""
    orders = table(spark, sf_dir, "orders")
    coded, encoding = label_encode(orders, "o_orderpriority")
    by_price = coded.select("o_orderkey", "label", F.expr(
        "CASE WHEN o_totalprice > 250000 THEN 4D ELSE 1D END").alias("prediction"))
    by_status = coded.select("o_orderkey", F.expr(
        "CASE o_orderstatus WHEN 'F' THEN 0D WHEN 'O' THEN 2D ELSE 3D END").alias("prediction"))
    return evaluate.predictions_table(by_price, by_status, "o_orderkey", encoding)


def written_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, write_predictions(predictions_of_orders(spark, sf_dir),
                                             scratch_path(spark, "out")))


def written_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary and class report as written and read back, side by side."""
    rows = predictions_of_orders(spark, sf_dir)
    summary = evaluate.metrics_summary(rows, "Actual", "Predicted_RF", "Predicted_KNN",
                                       CLASSIFICATION)
    report = evaluate.classification_report(rows, "Actual_Original", "Predicted_RF_Original")
    paths = write_metrics(summary, report, scratch_path(spark, "out"))
    first, second = (read_csv(spark, p) for p in paths)
    shares = first.selectExpr("inline(array(struct('rf' AS name, rf_accuracy AS value), "
                              "struct('knn' AS name, knn_accuracy AS value)))")
    classes = second.selectExpr("class_name AS name", "recall AS value")
    return shares.unionByName(classes).select("name", F.round("value", 9).alias("value"))


def written_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = cluster.cluster_profile(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"],
                                       "p_type")
    back = read_csv(spark, write_cluster_profiles(profiles, scratch_path(spark, "out")))
    return back.select("p_type", F.round("p_size", 6).alias("p_size"),
                       F.round("p_retailprice", 6).alias("p_retailprice"))


def _customer_points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.array("c_nationkey", "c_acctbal").alias("features"), F.expr(
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 "
            "WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END").alias("label"))
    flagged = split.stratified_split(rows, "label", ["c_custkey"])
    return flagged.where(~F.col("is_test")), flagged.where("is_test")


def knn_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _customer_points(spark, sf_dir)
    return knn.knn_classify(train, test, "c_custkey")


def knn_customer_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _customer_points(spark, sf_dir)
    return knn.knn_neighbours(train, test, "c_custkey", cell_rows=50).select(
        "qkey", "tkey", F.round("distance2", 6).alias("distance2"), "place")


def knn_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = datetimes.extract_datetime_features(table(spark, sf_dir, "orders"))
    rows = orders.select("o_orderkey", F.array(
        "o_custkey", "o_orderdate_year", "o_orderdate_month", "o_orderdate_day")
        .alias("features"), F.col("o_totalprice").alias("label"))
    flagged = split.stratified_split(rows, None, ["o_orderkey"])
    found = knn.knn_regress(flagged.where(~F.col("is_test")), flagged.where("is_test"),
                            "o_orderkey")
    return found.select("o_orderkey", F.round("prediction", 4).alias("prediction"))


def knn_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("features"), "label")
    flagged = split.stratified_split(rows, "label", ["vec_id"])
    return knn.knn_classify(flagged.where(~F.col("is_test")), flagged.where("is_test"), "vec_id")


def knn_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of lineitem against the rest; the SQL form would compare every pair."""
    lines = table(spark, sf_dir, "lineitem").select(
        row_key(LINE_KEYS).alias("row_id"), (F.col("l_linestatus") == "O").cast("double")
        .alias("label"), F.array(F.col("l_quantity") / 50, F.col("l_extendedprice") / 100000,
                                 F.col("l_discount") * 10, F.col("l_tax") * 10).alias("features"))
    flagged = split.stratified_split(lines, "label", ["row_id"])
    return knn.knn_classify(flagged.where(~F.col("is_test")), flagged.where("is_test"), "row_id")


def phi_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values laid out like a Shapley table: two classes, four features per line."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("class"), F.lit(f).alias("feature"), (F.expr(e) * w + 0.0).alias("phi"))
        for c, w in ((0, 1.0), (1, -0.5))
        for f, e in (("quantity", "l_quantity - 25"), ("discount", "l_discount * 100 - 5"),
                     ("tax", "l_tax * 100 - 4"), ("line", "double(l_linenumber)"))]))
    return table(spark, sf_dir, "lineitem").select(*LINE_KEYS, cells.alias("c")).select(
        *LINE_KEYS, "c.*")


PHI_SQL = "(" + "\nUNION ALL ".join(
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {c} AS class, '{f}' AS feature,
        ({e}) * ({w}::DOUBLE) + 0.0 AS phi FROM lineitem"""
    for c, w in ((0, 1.0), (1, -0.5))
    for f, e in (("quantity", "l_quantity - 25"), ("discount", "l_discount * 100 - 5"),
                 ("tax", "l_tax * 100 - 4"), ("line", "l_linenumber::DOUBLE"))) + ")"


def phi_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.shap_importance(phi_lines(spark, sf_dir)).select(
        "feature", F.round("importance", 6).alias("importance"))


def phi_of_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.shap_for_class(phi_lines(spark, sf_dir), 1).select(
        *LINE_KEYS, "feature", F.round("phi", 6).alias("phi"))


def phi_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding slots as features, with a value derived from each slot as phi."""
    vectors = table(spark, sf_dir, "embeddings")
    slots = vectors.select("vec_id", F.posexplode("embedding").alias("slot", "x"))
    names = [f"f{i}" for i in range(64)]
    label = F.concat(F.lit("f"), F.col("slot").cast("string"))
    phi = slots.select("vec_id", F.lit(0).alias("class"), label.alias("feature"),
                       (F.col("x").cast("double") * (F.col("slot") + 1)).alias("phi"))
    rows = vectors.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>"))
                          .alias("features"))
    return explain.shap_points(phi, rows, "vec_id", names).select(
        "vec_id", "feature", F.round("value", 6).alias("value"), F.round("phi", 6).alias("phi"))


QUICK = RunConfig(forest_trees=10, forest_depth=5, kmeans_restarts=2, kmeans_max_iter=10,
                  shap_rows=100, shap_background=50, pdp_rows=100, pdp_grid=20)


def report_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run on lineitem: class report of the forest on the test rows."""
    result = run_table(table(spark, sf_dir, "lineitem"), QUICK)
    return result.tables["class_report"]


def report_orders_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = RunConfig(**{**QUICK.__dict__, "target_col": "o_totalprice",
                          "key_cols": ["o_orderkey"]})
    return run_table(table(spark, sf_dir, "orders"), config).tables["metrics_summary"]


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows made ready by a run that was saved and loaded: the fit's medians fill the gaps."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_retailprice",
        F.when(F.col("p_partkey") % 7 > 0, F.col("p_size")).alias("size"))
    config = RunConfig(**{**QUICK.__dict__, "target_col": "p_retailprice",
                          "key_cols": ["p_partkey"]})
    folder = save(run_table(parts, config), parts.schema, scratch_path(spark, "stored"))
    ready = load(spark, folder).transform(parts)
    return ready.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_brand", "size")


QUERIES = {
    "run_stored_features": stored_features,
    "predictions_table": predictions_of_orders,
    "sink_predictions": written_predictions,
    "sink_metrics": written_metrics,
    "sink_cluster_profiles": written_profiles,
    "forest_classifier": forest_classifier,
    "forest_regressor": forest_regressor,
    "forest_importance": importance_table,
    "forest_first_tree": first_tree,
    "forest_shap_values": shap_table,
    "forest_shap_additive": shap_additive,
    "forest_support": forest_support,
    "forest_partial_dependence": pdp_table,
    "knn_classify_customer": knn_customer,
    "knn_neighbours_customer": knn_customer_neighbours,
    "knn_regress_orders": knn_orders,
    "knn_classify_embeddings": knn_embeddings,
    "knn_classify_lineitem": knn_lineitem,
    "shap_importance": phi_importance,
    "shap_for_class": phi_of_class,
    "shap_points": phi_points,
    "report_lineitem": report_lineitem,
    "report_orders_regression": report_orders_regression,
}


def _neighbours_sql(flagged: str, key: str, distance: str) -> str:
    return f"""(SELECT * FROM (SELECT q.{key} AS qkey, t.{key} AS tkey, t.label,
            {distance} AS distance2, row_number() OVER (PARTITION BY q.{key}
                ORDER BY {distance}, t.{key}) AS place
        FROM (SELECT * FROM ({flagged}) WHERE is_test) q
        JOIN (SELECT * FROM ({flagged}) WHERE NOT is_test) t ON true) WHERE place <= 5)"""


def _vote_sql(neighbours: str, key: str) -> str:
    return f"""SELECT qkey AS {key}, label::DOUBLE AS prediction FROM (
        SELECT qkey, label, row_number() OVER (PARTITION BY qkey ORDER BY count(*) DESC, label)
            AS r FROM {neighbours} GROUP BY qkey, label) WHERE r = 1"""


_CUSTOMER = split_sql(
    """(SELECT *, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
        WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END AS label FROM customer)""",
    "c_custkey, c_nationkey, c_acctbal", "c_custkey", "label", "label")
_CUSTOMER_KNN = _neighbours_sql(
    _CUSTOMER, "c_custkey", "((q.c_nationkey - t.c_nationkey) * (q.c_nationkey - t.c_nationkey) "
    "+ (q.c_acctbal - t.c_acctbal) * (q.c_acctbal - t.c_acctbal))")
_ORDERS = split_sql(
    """(SELECT o_orderkey, o_custkey, year(o_orderdate) AS y, month(o_orderdate) AS m,
        day(o_orderdate) AS d, o_totalprice AS label FROM orders)""",
    "o_orderkey, o_custkey, y, m, d", "o_orderkey", "0", "label")
_ORDERS_KNN = _neighbours_sql(_ORDERS, "o_orderkey", " + ".join(
    f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in ("o_custkey", "y", "m", "d")))
_KINDS = split_sql(
    f"""(SELECT {LINE_KEY_SQL} AS row_id, CASE WHEN l_quantity > 30 AND l_discount > 0.04
        THEN 'big' WHEN l_tax > 0.05 THEN 'taxed' ELSE 'plain' END AS kind FROM lineitem)""",
    "row_id", "row_id", "kind", "kind")
_VECTORS = split_sql("embeddings", "vec_id, embedding", "vec_id", "label", "label")

_PRIORITIES = "(SELECT DISTINCT o_orderpriority AS p FROM orders)"
_RULES = f"""(SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 4 ELSE 1 END AS rf,
        CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 2 ELSE 3 END AS knn, o_orderpriority
        FROM orders)"""
_PREDICTIONS = f"""WITH codes AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS c
        FROM {_PRIORITIES})
    SELECT o_orderkey, a.c::INTEGER AS "Actual", rf::INTEGER AS "Predicted_RF",
        knn::INTEGER AS "Predicted_KNN", o_orderpriority AS "Actual_Original",
        r.p AS "Predicted_RF_Original", k.p AS "Predicted_KNN_Original"
    FROM {_RULES} JOIN codes a ON a.p = o_orderpriority JOIN codes r ON r.c = rf
        JOIN codes k ON k.c = knn"""

SQL = {
    "run_stored_features": """WITH parts AS (SELECT p_partkey::BIGINT AS p_partkey, p_brand,
            CASE WHEN p_partkey % 7 > 0 THEN p_size::DOUBLE END AS size FROM part)
        SELECT p_partkey, p_brand, coalesce(size, (SELECT median(size) FROM parts)) AS size
        FROM parts""",
    "predictions_table": _PREDICTIONS,
    "sink_predictions": f"""SELECT o_orderkey::BIGINT AS o_orderkey, "Actual"::BIGINT AS "Actual",
        "Predicted_RF"::BIGINT AS "Predicted_RF", "Predicted_KNN"::BIGINT AS "Predicted_KNN",
        "Actual_Original", "Predicted_RF_Original", "Predicted_KNN_Original"
        FROM ({_PREDICTIONS})""",
    "sink_metrics": f"""WITH t AS ({_PREDICTIONS}), c AS (SELECT "Actual_Original" AS name,
            avg(("Actual" = "Predicted_RF")::INTEGER::DOUBLE) AS value, count(*) AS n
            FROM t GROUP BY 1)
        SELECT 'rf' AS name, round(avg(("Actual" = "Predicted_RF")::INTEGER::DOUBLE), 9) AS value
            FROM t
        UNION ALL SELECT 'knn', round(avg(("Actual" = "Predicted_KNN")::INTEGER::DOUBLE), 9) FROM t
        UNION ALL SELECT 'accuracy', round(avg(("Actual" = "Predicted_RF")::INTEGER::DOUBLE), 9)
            FROM t
        UNION ALL SELECT name, round(value, 9) FROM c
        UNION ALL SELECT 'macro avg', round(avg(value), 9) FROM c
        UNION ALL SELECT 'weighted avg', round(sum(value * n) / sum(n), 9) FROM c""",
    "sink_cluster_profiles": """SELECT p_type, round(avg(p_size), 6) AS p_size,
        round(avg(p_retailprice), 6) AS p_retailprice FROM part GROUP BY p_type""",
    "forest_shap_additive": f"""SELECT row_id, class::INTEGER AS class, true AS adds_up
        FROM (SELECT row_id FROM ({_KINDS}) WHERE is_test ORDER BY md5('42:' || row_id) LIMIT 500),
            (VALUES (0), (1), (2)) AS c(class)""",
    "forest_support": f"""SELECT kind AS actual, count(*)::BIGINT AS n FROM ({_KINDS})
        WHERE is_test GROUP BY kind""",
    "knn_classify_customer": _vote_sql(_CUSTOMER_KNN, "c_custkey"),
    "knn_neighbours_customer": f"""SELECT qkey, tkey, round(distance2, 6) AS distance2,
        place::INTEGER AS place FROM {_CUSTOMER_KNN}""",
    "knn_regress_orders": f"""SELECT qkey AS o_orderkey, round(avg(label), 4) AS prediction
        FROM {_ORDERS_KNN} GROUP BY qkey""",
    "knn_classify_embeddings": _vote_sql(_neighbours_sql(
        _VECTORS, "vec_id", "list_sum(list_transform(list_zip(q.embedding, t.embedding), "
        "lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))"), "vec_id"),
    "shap_importance": f"""SELECT feature, round(avg(abs(phi)), 6) AS importance FROM {PHI_SQL}
        GROUP BY feature ORDER BY avg(abs(phi)) DESC, feature LIMIT 20""",
    "shap_for_class": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, feature,
        round(phi, 6) AS phi FROM {PHI_SQL} WHERE class = 1""",
    "shap_points": """WITH cells AS (SELECT vec_id, 'f' || (i - 1)::VARCHAR AS feature,
            embedding[i]::DOUBLE AS value, embedding[i]::DOUBLE * i AS phi
            FROM embeddings, range(1, 65) AS r(i)),
        top AS (SELECT feature FROM cells GROUP BY feature ORDER BY avg(abs(phi)) DESC, feature
            LIMIT 20)
        SELECT vec_id, feature, round(value, 6) AS value, round(phi, 6) AS phi
        FROM cells WHERE feature IN (SELECT feature FROM top)""",
}
