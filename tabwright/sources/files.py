"""File readers: delimited text, JSON and Parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.config import NULL_TOKENS
from tabwright.functions.columns import is_text, name, strip
from tabwright.functions.texts import text_to_boolean, text_to_double, text_to_long
from tabwright.sources import documents
from tabwright.sources.records import read_records


@dataclass
class TextShape:
    """What a scan of the raw lines tells about delimited files."""

    #: The one encoding of all files; None if there are several.
    encoding: str | None
    #: Whether quoted values span lines.
    multi_line: bool


def file_encodings(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``encoding``, decided for each file by its bytes: UTF-8 if every line is valid,
    else ISO-8859-1."""
    valid = F.bool_and(F.is_valid_utf8("value"))
    return spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.when(valid, "UTF-8").otherwise("ISO-8859-1").alias("encoding"))


def inspect_text(spark: SparkSession, path: str) -> TextShape:
    """Encodings and whether quoted values span lines, in one scan.

    Spark's reader replaces bad bytes instead of failing, so the bytes are checked here, file by file.
    """
    line = F.col("value")
    row = (spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.bool_and(F.is_valid_utf8(line)).alias("utf8"),
        F.bool_or(F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1).alias("open_quote"))
        .agg(F.bool_and("utf8").alias("all_utf8"), F.bool_or("utf8").alias("any_utf8"),
             F.bool_or("open_quote").alias("open_quote")).first())
    encoding = "UTF-8" if row.all_utf8 is not False else None if row.any_utf8 else "ISO-8859-1"
    return TextShape(encoding, bool(row.open_quote))


def resolve_encoding(spark: SparkSession, path: str) -> str | None:
    """UTF-8 if every line is valid UTF-8, ISO-8859-1 if no file is, None if files differ."""
    return inspect_text(spark, path).encoding


def normalise_null_tokens(df: DataFrame) -> DataFrame:
    """Text that stands for a missing value becomes NULL."""
    return df.withColumns({f.name: F.when(~strip(name(f.name)).isin(*NULL_TOKENS), name(f.name))
                           for f in df.schema if is_text(f.dataType)})


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns become long, double or boolean where every present value reads as such.

    One aggregate decides for all columns.
    """
    readers = {"long": text_to_long, "double": text_to_double, "boolean": text_to_boolean}
    columns = [f.name for f in df.schema if is_text(f.dataType)]
    if not columns:
        return df
    row = df.agg(*[m for i, c in enumerate(columns) for m in (
        F.count(name(c)).alias(f"n{i}"),
        *[F.count(read(name(c))).alias(f"{kind}{i}") for kind, read in readers.items()])]).first()
    casts = {}
    for i, c in enumerate(columns):
        kind = next((k for k in readers if row[f"n{i}"] and row[f"{k}{i}"] == row[f"n{i}"]), None)
        if kind:
            casts[c] = readers[kind](name(c))
    return df.withColumns(casts) if casts else df


def read_delimited(spark: SparkSession, path: str, sep: str | None = ",") -> DataFrame:
    """Header row, null markers, inferred types; an empty separator means comma.

    Files of one encoding without quoted line ends are left to Spark's reader, which splits them by
    lines; others are cut into rows first (see :mod:`tabwright.sources.records`).
    """
    shape, sep = inspect_text(spark, path), (sep or ",").replace("\\t", "\t")
    if shape.multi_line or shape.encoding is None:
        raw = read_records(spark, path, sep)
    else:
        raw = spark.read.csv(path, header=True, sep=sep, encoding=shape.encoding, escape='"',
                             inferSchema=False, enforceSchema=False)
    return infer_types(normalise_null_tokens(raw))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, ",")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents that hold a table: arrays of records, or objects of columns.

    The column form ``{"column": {"row": value}}`` is laid out as cells and pivoted by row. A document
    of any length is read by many tasks (see :mod:`tabwright.sources.documents`).
    """
    if documents.opening(spark, path) == "{":
        return infer_types(documents.read_columns(spark, path))
    return documents.read_array(spark, path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
