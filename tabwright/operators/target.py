"""Target choice, task type and label encoding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.config import COMMON_TARGET_NAMES, ID_NAME_PARTS
from tabwright.functions.columns import is_text, name
from tabwright.operators.dictionary import SENT_BYTES, SENT_WHOLE, Dictionary
from tabwright.operators.profile import profile_columns

CLASSIFICATION, REGRESSION = "classification", "regression"


def task_type_rule() -> Column:
    """Task type from the columns of a profile row."""
    few = (F.col("distinct_ratio") < 0.05) & (F.col("distinct_count") < 100)
    classes = ((F.col("type_class") != "numeric") | (F.col("distinct_count") == 2)
               | (few & F.col("is_integral") & (F.col("distinct_count") > 0)))
    return F.when(classes, CLASSIFICATION).otherwise(REGRESSION)


def task_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return profile_columns(df, columns).select(
        "ordinal", "column_name", "row_count", "distinct_count",
        task_type_rule().alias("task_type"))


def detect_task_type(df: DataFrame, column: str) -> str:
    if isinstance(df.schema[column].dataType, (T.StringType, T.BooleanType)):
        if df.isEmpty():
            raise ValueError("target column is empty, cannot detect the task type")
        return CLASSIFICATION
    rows = task_types(df, [column]).collect()
    if not rows:
        raise ValueError("target column is empty, cannot detect the task type")
    return rows[0].task_type


def has_id_name(column: str) -> bool:
    return any(part in column.lower() for part in ID_NAME_PARTS)


def _lower() -> Column:
    return F.lower("column_name")


def target_candidates(profile: DataFrame, missing_threshold: float = 0.5) -> DataFrame:
    """Profile rows that may be a target, with the path that admitted them.

    The table has one row per column, so the window over all of it stays tiny.
    """
    id_like = F.lit(False)
    for part in ID_NAME_PARTS:
        id_like = id_like | _lower().contains(part)
    by_name = ~id_like | (_lower().isin(*ID_NAME_PARTS) & (F.col("distinct_ratio") < 0.95))
    usable = (F.col("distinct_count") > 1) & (F.col("missing_ratio") <= missing_threshold)
    strict = by_name & (F.col("distinct_count") < F.col("row_count")) & usable
    flagged = profile.withColumns({"strict": strict, "usable": usable})
    any_strict = F.max("strict").over(Window.partitionBy(F.lit(1)))
    return (flagged.withColumn("any_strict", any_strict)
            .where(F.col("strict") | (~F.col("any_strict") & F.col("usable")))
            .withColumn("path", F.when(F.col("strict"), "filtered").otherwise("fallback"))
            .drop("strict", "usable", "any_strict"))


def match_common_target_name(candidates: DataFrame) -> DataFrame:
    """Adds the position of the column name in the list of usual target names, else NULL."""
    position = F.array_position(F.array(*[F.lit(n) for n in COMMON_TARGET_NAMES]), _lower())
    return candidates.withColumn("name_rank", F.when(position > 0, position.cast("int")))


def rank_targets(profile: DataFrame, missing_threshold: float = 0.5) -> DataFrame:
    """Candidates in order of preference, best first in ``target_rank``."""
    candidates = match_common_target_name(target_candidates(profile, missing_threshold))
    typed = candidates.withColumn("task_type", task_type_rule())
    priority = (F.when(F.col("task_type") == REGRESSION, -F.col("distinct_ratio"))
                .when(F.col("distinct_count") == 2, F.lit(0.0))
                .otherwise(F.col("distinct_ratio")))
    order = Window.partitionBy(F.lit(1)).orderBy(
        F.col("name_rank").asc_nulls_last(),
        (F.col("task_type") == REGRESSION).asc(), F.col("priority").asc(), F.col("ordinal").asc())
    return (typed.withColumn("priority", priority)
            .withColumn("target_rank", F.row_number().over(order))
            .select("target_rank", "ordinal", "column_name", "task_type", "distinct_count",
                    "missing_ratio", "priority", "name_rank", "path"))


def choose_target(df: DataFrame, missing_threshold: float = 0.5) -> str:
    """Best target column of a table.

    Exact distinct counts of key-like columns are the costly ones, and their names already rule
    them out; they are counted only where nothing else is left.
    """
    named = [c for c in df.columns if not has_id_name(c) or c.lower() in ID_NAME_PARTS]
    everything = list(df.columns)
    for columns in ([named, everything] if named else [everything]):
        best = (rank_targets(profile_columns(df, columns), missing_threshold)
                .orderBy("target_rank").select("column_name", "path").first())
        if best and (best.path == "filtered" or columns is everything):
            return best.column_name
    raise ValueError("no suitable target column found")


def resolve_target(df: DataFrame, manual: str | None = None, stored: str | None = None,
                   missing_threshold: float = 0.5) -> str:
    """The manual choice if the table has it, else the stored one, else the ranked best."""
    for choice in (manual, stored):
        if choice and choice in df.columns:
            return choice
    return choose_target(df, missing_threshold)


def needs_encoding(df: DataFrame, target: str) -> bool:
    return is_text(df.schema[target].dataType)


@dataclass
class LabelEncoding:
    """Codes of the target classes, in the order of their text.

    ``classes`` lists them where they are few, else ``dictionary`` holds them as a table; a numeric
    target has neither.
    """

    target: str
    classes: list[str] | None
    dictionary: Dictionary | None = None

    @property
    def coded(self) -> bool:
        return self.classes is not None or self.dictionary is not None

    @classmethod
    def fit(cls, df: DataFrame, target: str) -> "LabelEncoding":
        if not needs_encoding(df, target):
            return cls(target, None)
        dictionary = Dictionary.fit(df, name(target))
        if dictionary.size > SENT_WHOLE or dictionary.bytes > SENT_BYTES:
            return cls(target, None, dictionary)
        return cls(target, [r.value for r in dictionary.entries.orderBy("code").collect()])

    def transform(self, df: DataFrame, output: str = "label") -> DataFrame:
        """Adds the numeric target: class code, or the value itself as double. Values that are not
        among the classes are an error."""
        if not self.coded:
            return df.withColumn(output, name(self.target).cast("double"))
        if self.dictionary is not None:
            # The error shows the head of the value, so that long texts need not follow their rows.
            shown = "dictionary shown"
            unseen = F.raise_error(F.concat(F.lit(f"{self.target} is no class seen before: "),
                                            F.coalesce(name(shown), F.lit("null"))))
            headed = df.withColumn(shown, F.substring(name(self.target).cast("string"), 1, 100))
            return self.dictionary.encode(headed, self.target, output).withColumn(
                output, F.coalesce(name(output).cast("double"), unseen.cast("double"))).drop(shown)
        model = StringIndexerModel.from_labels(self.classes, inputCol=self.target,
                                               outputCol=output, handleInvalid="error")
        return model.transform(df)

    def decode(self, df: DataFrame, columns: dict[str, str]) -> DataFrame:
        """Adds, per coded column, a column with the class text of its code."""
        for code, text in columns.items():
            if self.dictionary is not None:
                df = self.dictionary.decode(df, code, text)
                continue
            coded = df.withColumn("_code", name(code).cast("double"))
            df = IndexToString(inputCol="_code", outputCol=text,
                               labels=self.classes).transform(coded).drop("_code")
        return df


def label_encode(df: DataFrame, target: str) -> tuple[DataFrame, LabelEncoding]:
    encoding = LabelEncoding.fit(df, target)
    encoded = encoding.transform(df, "label")
    if encoding.coded:
        encoded = encoded.withColumn("label", F.col("label").cast("int"))
    return encoded, encoding


def label_decode(df: DataFrame, encoding: LabelEncoding, columns: list[str]) -> DataFrame:
    """Adds ``<column>_Original`` with the class text of each coded column."""
    if not encoding.coded:
        return df
    return encoding.decode(df, {c: f"{c}_Original" for c in columns})
