"""Runs saved and loaded: equal predictions without a fit, drifted tables, versions."""

import json

import pytest
from pyspark.sql import functions as F

from tabwright.config import RunConfig
from tabwright.plans import load, run, save
from tabwright.plans.analysis import run_table
from tabwright.plans.processing import ROW_ID
from tabwright.sources.loading import file_source, load_clean

SMALL = dict(forest_trees=4, forest_depth=4, kmeans_restarts=2, kmeans_max_iter=5, shap_rows=5,
             shap_background=4, pdp_rows=20, pdp_grid=4)


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    source = file_source(f"{sf}/events.parquet")
    result = run(spark, source, RunConfig(**SMALL))
    folder = str(tmp_path_factory.mktemp("stored") / "run")
    save(result, load_clean(spark, source).schema, folder)
    return result, folder


def test_a_new_session_predicts_the_same(spark, stored):
    result, folder = stored
    again = load(spark.newSession(), folder)
    wanted = {r[ROW_ID]: (r.Predicted_RF, r.Predicted_RF_Original)
              if "Predicted_RF_Original" in r else (r.Predicted_RF,)
              for r in result.tables["predictions"].collect()}
    scored = {r[ROW_ID]: tuple(r)[1:] for r in again.score_source(spark).collect()}
    assert wanted and {k: scored[k] for k in wanted} == wanted
    assert again.model.clusters is None or again.model.clusters.cost == result.model.clusters.cost


def test_transformed_rows_equal_those_of_the_fit(spark, stored):
    result, folder = stored
    again = load(spark, folder)
    rows = again.transform(load_clean(spark, again.source))
    numeric = result.model.roles.numeric
    ours = {r[ROW_ID]: [r[c] for c in numeric] for r in rows.collect()}
    for r in result.tables["processed"].collect():
        assert ours[r[ROW_ID]] == [r[c] for c in numeric]


def test_drifted_tables(spark, stored, sf):
    _, folder = stored
    again = load(spark, folder)
    df = load_clean(spark, again.source)
    columns = list(again.schema)
    gone = next(c for c in columns if c != again.model.target)
    other = next(c for c in columns if c not in (gone, again.model.target)
                 and again.schema[c] in ("bigint", "double", "int"))
    moved = df.drop(gone).withColumn(other, F.col(other).cast("string")).withColumn("more", F.lit(1))
    report = {r.column: (r.fitted_type, r.found_type, r.change) for r in again.drift(moved).collect()}
    assert report[gone] == (again.schema[gone], None, "missing")
    assert report[other] == (again.schema[other], "string", "type")
    assert report["more"] == (None, "int", "added")
    assert all(v[2] == "same" for k, v in report.items() if k not in (gone, other, "more"))
    assert again.score(moved).count() == df.count()
    assert again.score(df.drop(again.model.target)).count() == df.count()
    assert again.score(df.limit(0)).count() == 0


def test_numeric_target_and_other_versions(spark, tmp_path):
    df = spark.range(300).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("string")
                                 .alias("c"), (F.col("id") * 1.5).alias("y"))
    result = run_table(df, RunConfig(target_col="y", **SMALL))
    folder = save(result, df.schema, str(tmp_path / "run"))
    again = load(spark, folder)
    assert not again.model.encoding.coded
    wanted = {r[ROW_ID]: r.Predicted_RF for r in result.tables["predictions"].collect()}
    scored = {r[ROW_ID]: r.Predicted_RF for r in again.score(df).collect()}
    assert {k: scored[k] for k in wanted} == wanted
    with pytest.raises(ValueError, match="no stored source"):
        again.score_source(spark)
    state = json.loads(spark.read.text(f"{folder}/state").first().value)
    state["version"] = 0
    spark.createDataFrame([(json.dumps(state),)], "value string").write.mode("append") \
        .text(str(tmp_path / "old" / "state"))
    with pytest.raises(ValueError, match="version"):
        load(spark, str(tmp_path / "old"))
