"""Column-level expressions: missing values, roles, text keys and hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)
DATETIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)
TEXT_TYPES = (T.StringType, T.VarcharType, T.CharType)

# Characters stripped from both ends of a text value.
WHITESPACE = " \t\n\r\f\x0b"


def name(column: str) -> Column:
    """Reference a column whose name may hold dots or spaces."""
    return F.col("`" + column.replace("`", "``") + "`")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, TEXT_TYPES)


def is_datetime(dtype: T.DataType) -> bool:
    return isinstance(dtype, DATETIME_TYPES)


def missing(field: T.StructField) -> Column:
    """True where the value is NULL, or NaN in a floating column."""
    column = name(field.name)
    if isinstance(field.dataType, FLOAT_TYPES):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column, so that aggregates skip it."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, FLOAT_TYPES)]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(name(c)), name(c)) for c in floats})


def decimals_to_double(df: DataFrame) -> DataFrame:
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: name(c).cast("double") for c in decimals}) if decimals else df


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(WHITESPACE))


def row_key(columns: Sequence[str]) -> Column:
    """Text key of a row: the single key column, or its parts joined by ``|``."""
    if len(columns) == 1:
        return name(columns[0]).cast("string")
    return F.concat_ws("|", *[name(c).cast("string") for c in columns])


def hash_order(key: Column, seed: int) -> Column:
    """Seeded pseudo-random order that does not depend on the partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def row_hash(df: DataFrame) -> Column:
    """Identity of a row among distinct rows: a hash of its values as JSON text."""
    return F.md5(F.to_json(F.struct(*[name(c) for c in df.columns]),
                           {"ignoreNullFields": "false"}).cast("binary"))
