import pytest
from pyspark.sql import functions as F

from tabwright.config import RunConfig
from tabwright.plans.analysis import run_table
from tabwright.plans import ProcessingModel, distinct_rows, fit_processing, refresh, run
from tabwright.sources.loading import file_source

SMALL = dict(forest_trees=5, forest_depth=3, kmeans_restarts=1, kmeans_max_iter=5, shap_rows=20,
             shap_background=10, pdp_rows=30, pdp_grid=8)


@pytest.fixture(scope="module")
def events_run(spark, sf):
    return run(spark, file_source(f"{sf}/events.parquet"), RunConfig(**SMALL))


def test_classification_run(events_run):
    result = events_run
    assert (result.model.target, result.model.task_type) == ("event_type", "classification")
    assert result.model.numeric_json == ["props"]
    assert result.model.clock_parts == {"ts": ["hour", "minute"]}
    rows = result.tables["processed"].count()
    tests = result.tables["predictions"].count()
    assert tests == -(-rows // 5)
    assert {"class_report", "confusion_matrix", "feature_importance", "shap_values", "tree",
            "partial_dependence", "cluster_profiles", "correlation"} <= set(result.tables)
    assert result.tables["confusion_matrix"].agg(F.sum("n")).first()[0] == tests
    assert {"Actual_Original", "Predicted_RF_Original", "Predicted_KNN_Original"} <= set(
        result.tables["predictions"].columns)


def test_refresh_repeats_the_run(spark, events_run):
    again = refresh(spark, events_run)
    assert again.config.target_col == "event_type"
    columns = ["_row_id", "Actual", "Predicted_KNN", "Predicted_RF"]
    first = sorted(map(tuple, events_run.tables["predictions"].select(*columns).collect()))
    assert first == sorted(map(tuple, again.tables["predictions"].select(*columns).collect()))


def test_fitted_step_applies_to_new_rows(spark, sf, events_run):
    config = RunConfig(**SMALL)
    rows = distinct_rows(spark.read.parquet(f"{sf}/events.parquet").limit(50), config)
    model: ProcessingModel = events_run.model
    out = model.transform(rows)
    assert out.count() == rows.count() and "cluster" in out.columns


def test_regression_run_writes_its_tables(spark, sf, tmp_path):
    config = RunConfig(target_col="o_totalprice", key_cols=["o_orderkey"], cluster_fit="train",
                       **SMALL)
    result = run(spark, file_source(f"{sf}/orders.parquet"), config)
    assert result.model.task_type == "regression"
    assert {"residuals", "mean_comparison", "trend"} <= set(result.tables)
    assert result.tables["metrics_summary"].columns == ["rf_r2", "rf_mse", "knn_r2", "knn_mse"]
    paths = result.write(str(tmp_path))
    assert len(paths) == len(result.tables)
    assert spark.read.parquet(f"{tmp_path}/processed_data").count() == \
        result.tables["processed"].count()


def test_array_column_is_excluded_and_reported(spark, sf):
    config = RunConfig(target_col="label", **SMALL)
    rows = distinct_rows(spark.read.parquet(f"{sf}/embeddings.parquet"), config)
    model = fit_processing(rows, config)
    assert "embedding" in model.dropped and model.roles.numeric == ["vec_id"]


def test_config_round_trip():
    config = RunConfig(target_col="y", pdp_exclude=["x"])
    assert RunConfig.from_json(config.to_json()) == config


@pytest.mark.parametrize("method", ["rows", "covers"])
def test_dependence_by_joins_in_a_run(spark, method):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 11), 2.0 * (i % 7) + i % 11)
                                for i in range(120)], "row_key int, a double, b double, y double")
    config = RunConfig(target_col="y", task_type="regression", key_cols=["row_key"],
                       pdp_method=method, **SMALL)
    table = run_table(df, config).tables["partial_dependence"]
    assert table.columns == ["feature", "grid_value", "average"]
    assert table.where("feature in ('a', 'b')").groupBy("feature").count().count() == 2
