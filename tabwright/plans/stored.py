"""Fitted runs that last: saved to a folder, loaded in any later session, applied without a fit.

A folder holds ``state`` (one line of JSON with a version: settings, source, the schema that the fit
saw, and all fitted values), the models in Spark's own format, and the dictionary of a target with very
many classes. New data may have drifted: :meth:`StoredRun.drift` reports it column by column, and
:meth:`StoredRun.score` applies the fitted steps to what fits them.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.config import RunConfig, SourceSpec
from tabwright.functions.columns import name, row_hash, row_key
from tabwright.operators import features, forest
from tabwright.operators.cluster import ClusterModel
from tabwright.operators.dictionary import Dictionary
from tabwright.operators.target import CLASSIFICATION, LabelEncoding
from tabwright.plans.analysis import RunResult
from tabwright.plans.processing import ROW_ID, ProcessingModel
from tabwright.sources.loading import load_clean

#: Version of the folder's layout; other versions are refused.
VERSION = 2
#: Fields of the processing step that are plain values.
PLAIN = ("columns", "json_columns", "numeric_json", "text_dates", "clock_parts", "date_medians",
         "target", "task_type", "medians", "dropped")


@dataclass
class StoredRun:
    """A loaded run: its steps, settings and the column types that its fit saw."""

    model: ProcessingModel
    feature_model: features.FeatureModel
    forest: forest.ForestModel
    config: RunConfig
    source: SourceSpec | None
    schema: dict[str, str]

    def drift(self, df: DataFrame) -> DataFrame:
        """Columns of the fit and of ``df``: ``column``, ``fitted_type``, ``found_type`` and ``change``
        (same, missing, added or type)."""
        found = {f.name: f.dataType.simpleString() for f in df.schema}
        rows = []
        for column in dict.fromkeys([*self.schema, *found]):
            old, new = self.schema.get(column), found.get(column)
            change = "missing" if new is None else "added" if old is None else \
                "same" if old == new else "type"
            rows.append((column, old, new, change))
        return df.sparkSession.createDataFrame(
            rows, "column string, fitted_type string, found_type string, change string")

    def fitting(self, df: DataFrame) -> DataFrame:
        """The fit's columns out of ``df``, with the rows' identity: missing ones are null, others are
        cast to the fit's types (null where a value does not read as such), new ones are left out."""
        have = {f.name: f.dataType.simpleString() for f in df.schema}
        columns = []
        for column, kind in self.schema.items():
            if column not in have:
                value = F.lit(None).cast(kind)
            elif have[column] == kind:
                value = name(column)
            else:
                value = name(column).try_cast(kind)
            columns.append(value.alias(column))
        rows = df.select(*columns)
        key = row_key(self.config.key_cols) if self.config.key_cols else row_hash(rows)
        return rows.withColumn(ROW_ID, key)

    def transform(self, df: DataFrame) -> DataFrame:
        """Features of every row of ``df``, also of rows without a target: the row's identity, imputed
        numbers, categories, the cluster where there is one, and ``features``."""
        model = self.model
        work = model.expand(self.fitting(df))
        work = features.impute_median(work, model.roles.numeric, model.medians)
        work = features.impute_constant(work, model.roles.categorical)
        if model.clusters is not None:
            work = model.clusters.transform(work)
        return self.feature_model.transform(work)

    def score(self, df: DataFrame) -> DataFrame:
        """The forest's prediction for every row, with the class text where the target has one."""
        scored = forest.predict(self.forest, self.transform(df)).select(
            ROW_ID, F.col("prediction").alias("Predicted_RF"))
        encoding = self.model.encoding
        if not encoding.coded:
            return scored
        coded = scored.withColumn("Predicted_RF", F.col("Predicted_RF").cast("int"))
        return encoding.decode(coded, {"Predicted_RF": "Predicted_RF_Original"})

    def score_source(self, spark: SparkSession) -> DataFrame:
        """Predictions for the stored source, read again."""
        if self.source is None:
            raise ValueError("the run has no stored source to read again")
        return self.score(load_clean(spark, self.source, self.config.column_missing_threshold))


def save(result: RunResult, schema: T.StructType, folder: str) -> str:
    """Write the fitted steps of a run under ``folder`` (which must not hold a run yet). ``schema`` is
    that of the loaded table; only the columns that the fit kept are stored."""
    spark = result.tables["processed"].sparkSession
    model, vectors = result.model, result.feature_model
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    state = {
        "version": VERSION, "config": result.config.to_json(),
        "source": result.source.to_json() if result.source else None,
        "schema": {c: kinds[c] for c in model.columns},
        "processing": {f: getattr(model, f) for f in PLAIN}, "roles": asdict(model.roles),
        "classes": model.encoding.classes,
        "dictionary": [model.encoding.dictionary.size, model.encoding.dictionary.rows,
                       model.encoding.dictionary.bytes] if model.encoding.dictionary else None,
        "clusters": {"columns": model.clusters.columns, "scaling": asdict(model.clusters.scaling),
                     "centres": model.clusters.centres, "cost": model.clusters.cost} if model.clusters else None,
        "features": {"roles": asdict(vectors.roles), "medians": vectors.medians,
                     "scaling": asdict(vectors.scaling), "names": vectors.feature_names,
                     "numeric_slots": vectors.numeric_slots,
                     "encoded": vectors.encoders is not None}}
    result.forest.write().save(f"{folder}/forest")
    if vectors.encoders is not None:
        vectors.encoders.write().save(f"{folder}/encoders")
    if model.encoding.dictionary:
        model.encoding.dictionary.entries.write.parquet(f"{folder}/dictionary")
    # The state comes last: a folder without it holds no whole run.
    spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1) \
        .write.text(f"{folder}/state")
    return folder


def load(spark: SparkSession, folder: str) -> StoredRun:
    """A run saved by :func:`save`."""
    state = json.loads(spark.read.text(f"{folder}/state").first().value)
    if state["version"] != VERSION:
        raise ValueError(f"{folder} has version {state['version']}, expected {VERSION}")
    plain, kept, vectors = state["processing"], state["clusters"], state["features"]
    dictionary = Dictionary(spark.read.parquet(f"{folder}/dictionary"), *state["dictionary"]) \
        if state["dictionary"] else None
    clusters = ClusterModel(kept["columns"], features.Scaling(**kept["scaling"]),
                            kept["centres"], kept["cost"]) if kept else None
    model = ProcessingModel(
        **plain, encoding=LabelEncoding(plain["target"], state["classes"], dictionary),
        roles=features.FeatureRoles(**state["roles"]), clusters=clusters)
    encoders = PipelineModel.load(f"{folder}/encoders") if vectors["encoded"] else None
    feature_model = features.FeatureModel(
        features.FeatureRoles(**vectors["roles"]), vectors["medians"],
        features.Scaling(**vectors["scaling"]), encoders, vectors["names"],
        vectors["numeric_slots"])
    kind = RandomForestClassificationModel if plain["task_type"] == CLASSIFICATION \
        else RandomForestRegressionModel
    source = SourceSpec.from_json(state["source"]) if state["source"] else None
    return StoredRun(model, feature_model, kind.load(f"{folder}/forest"),
                     RunConfig.from_json(state["config"]), source, state["schema"])
