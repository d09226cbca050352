"""Feature roles, imputation, standardising, one-hot encoding and the feature vector."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.config import MISSING_LEVEL
from tabwright.functions.columns import is_numeric, is_text, missing, name
from tabwright.operators.dictionary import Dictionary
from tabwright.operators.order_stats import exact_medians

CLUSTER = "cluster"

# A sketch of distinct counts is off by far less than this factor; nearer to a limit they are counted.
SKETCH_ROOM = 2


@dataclass
class FeatureRoles:
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    excluded: dict[str, str] = field(default_factory=dict)


def split_feature_roles(df: DataFrame, target: str, ignore: Sequence[str] = ()) -> FeatureRoles:
    """Numeric and categorical features by type; other types are excluded with a reason."""
    roles = FeatureRoles()
    for f in df.schema:
        if f.name == target or f.name in ignore:
            continue
        if f.name == CLUSTER:
            roles.categorical.append(f.name)
        elif is_numeric(f.dataType):
            roles.numeric.append(f.name)
        elif is_text(f.dataType) or isinstance(f.dataType, T.BooleanType):
            roles.categorical.append(f.name)
        else:
            roles.excluded[f.name] = f"type {f.dataType.simpleString()} is not a feature type"
    return roles


def level_text(df: DataFrame, column: str) -> Column:
    """Level of a categorical value as text; the stand-in level where it is missing."""
    value = name(column)
    if isinstance(df.schema[column].dataType, T.BooleanType):
        value = F.when(value, "True").when(~value, "False")
    return F.coalesce(value.cast("string"), F.lit(MISSING_LEVEL))


def impute_median(df: DataFrame, columns: Sequence[str],
                  medians: dict[str, float | None] | None = None) -> DataFrame:
    """Missing numbers become the exact median of the column; only those columns turn double."""
    if medians is None:
        medians = exact_medians(df, columns)
    filled = {c: F.when(missing(df.schema[c]), F.lit(medians[c]))
              .otherwise(name(c).cast("double")) for c in columns}
    return df.withColumns(filled) if filled else df


def impute_constant(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: level_text(df, c) for c in columns}) if columns else df


@dataclass
class Scaling:
    """Mean and population deviation per column; a zero deviation divides by one."""

    centre: dict[str, float]
    spread: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> "Scaling":
        if not columns:
            return cls({}, {})
        row = df.agg(*[m for i, c in enumerate(columns) for m in (
            F.avg(name(c)).alias(f"a{i}"), F.stddev_pop(name(c)).alias(f"s{i}"))]).first()
        return cls({c: row[f"a{i}"] or 0.0 for i, c in enumerate(columns)},
                   {c: row[f"s{i}"] or 1.0 for i, c in enumerate(columns)})

    def expression(self, column: str) -> Column:
        return (name(column).cast("double") - F.lit(self.centre[column])) \
            / F.lit(self.spread[column])


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    scaling = Scaling.fit(df, columns)
    return df.withColumns({c: scaling.expression(c) for c in columns})


def fit_one_hot(df: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Indexer and encoder for text columns.

    Levels are ordered by text. The indexer keeps one spare slot for unseen levels, which is the
    slot the encoder drops: all seen levels stay and an unseen one is all zeros.
    """
    indexed = [f"_ix_{c}" for c in columns]
    indexer = StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep",
                            stringOrderType="alphabetAsc")
    encoder = OneHotEncoder(inputCols=indexed, outputCols=[f"_oh_{c}" for c in columns],
                            dropLast=True)
    return Pipeline(stages=[indexer, encoder]).fit(df)


def one_hot_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One 0/1 column ``<column>_<level>`` per level, next to the original columns."""
    text = df.withColumns({c: level_text(df, c) for c in columns})
    labels = fit_one_hot(text.select(*columns), columns).stages[0].labelsArray
    return df.withColumns({f"{c}_{level}": (level_text(df, c) == F.lit(level)).cast("int")
                           for c, levels in zip(columns, labels) for level in levels})


def wide_categoricals(df: DataFrame, columns: Sequence[str],
                      limit: int | None = None) -> dict[str, str]:
    """Categorical columns with more levels than allowed, by exact counts.

    One sketch aggregate for all columns; those that it puts near the limit are counted. The stand-in
    level of missing values counts as one.
    """
    if not columns or limit is None:
        return {}
    levels = {c: level_text(df, c) for c in columns}
    row = df.agg(*[F.approx_count_distinct(levels[c], 0.02).alias(f"d{i}")
                   for i, c in enumerate(columns)]).first()
    counts = {c: row[f"d{i}"] for i, c in enumerate(columns)}
    near = [c for c, n in counts.items() if limit < n * SKETCH_ROOM and n <= limit * SKETCH_ROOM]
    # One count a column keeps each a plain pair of partial aggregates, without a copy of the rows.
    counts |= {c: df.select(levels[c]).distinct().count() for c in near}
    return {c: f"{n if c in near else f'about {n}'} levels, more than max_onehot_levels={limit}"
            for c, n in counts.items() if n > limit}


def level_codes(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, Dictionary]]:
    """Adds ``<column>_code`` per categorical column: the code of its level in the order of the text,
    for any number of levels; also the dictionaries, which encode further rows (unseen levels: null)."""
    found = {c: Dictionary.fit(df, level_text(df, c)) for c in columns}
    for c, dictionary in found.items():
        text = f"_level_{c}"
        df = dictionary.encode(df.withColumn(text, level_text(df, c)), text, f"{c}_code") \
            .drop(text)
    return df, found


@dataclass
class FeatureModel:
    """Fitted feature step: imputed and standardised numbers, then one-hot levels, as a vector."""

    roles: FeatureRoles
    medians: dict[str, float | None]
    scaling: Scaling
    encoders: PipelineModel | None
    feature_names: list[str]
    numeric_slots: int

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        roles = self.roles
        work = df.withColumns({
            **{f"_num_{c}": F.coalesce(F.when(~missing(df.schema[c]), name(c).cast("double")),
                                       F.lit(self.medians[c])) for c in roles.numeric},
            **{f"_cat_{c}": level_text(df, c) for c in roles.categorical}})
        inputs = []
        if roles.numeric:
            work = work.withColumns({f"_num_{c}": (F.col(f"`_num_{c}`")
                                                   - F.lit(self.scaling.centre[f"_num_{c}"]))
                                     / F.lit(self.scaling.spread[f"_num_{c}"])
                                     for c in roles.numeric})
            inputs += [f"_num_{c}" for c in roles.numeric]
        if self.encoders is not None:
            work = self.encoders.transform(work)
            inputs += [f"_oh__cat_{c}" for c in roles.categorical]
        vector = VectorAssembler(inputCols=inputs, outputCol=output).transform(work)
        return vector.select(*[name(c) for c in df.columns if c != output], output)


def fit_features(df: DataFrame, target: str, ignore: Sequence[str] = (),
                 max_levels: int | None = None) -> FeatureModel:
    """Fit imputation, scaling and encoding on the training rows."""
    roles = split_feature_roles(df, target, ignore)
    roles.excluded.update(wide_categoricals(df, roles.categorical, max_levels))
    roles.categorical = [c for c in roles.categorical if c not in roles.excluded]
    medians = exact_medians(df, roles.numeric)
    unusable = [c for c in roles.numeric if medians[c] is None]
    roles.excluded.update({c: "no present value to impute from" for c in unusable})
    roles.numeric = [c for c in roles.numeric if c not in unusable]
    if not roles.numeric and not roles.categorical:
        raise ValueError("no numeric or categorical feature to model")
    numbers = df.select(*[F.coalesce(F.when(~missing(df.schema[c]), name(c).cast("double")),
                                     F.lit(medians[c])).alias(f"_num_{c}")
                          for c in roles.numeric])
    scaling = Scaling.fit(numbers, [f"_num_{c}" for c in roles.numeric])
    encoders, names = None, list(roles.numeric)
    if roles.categorical:
        levels = df.select(*[level_text(df, c).alias(f"_cat_{c}") for c in roles.categorical])
        encoders = fit_one_hot(levels, [f"_cat_{c}" for c in roles.categorical])
        names += [f"{c}_{level}" for c, column in
                  zip(roles.categorical, encoders.stages[0].labelsArray) for level in column]
    return FeatureModel(roles, medians, scaling, encoders, names, len(roles.numeric))


def assemble(df: DataFrame, model: FeatureModel) -> DataFrame:
    return model.transform(df)


def feature_names(model: FeatureModel, size: int | None = None) -> list[str]:
    """Names of the vector slots; numbered names if they do not fit the vector."""
    if size is not None and size != len(model.feature_names):
        return [f"feature_{i}" for i in range(size)]
    return list(model.feature_names)
