"""Helpers shared by the text operators: tables, small totals, Arrow batches, identifiers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``SLICE_ROWS``, so that long texts stay bounded."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def crc32_of(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes as a long."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_field(df: DataFrame, name: str, kind: str | T.DataType) -> T.StructType:
    """Schema of ``df`` and one more field."""
    kind = T.DataType.fromDDL(kind) if isinstance(kind, str) else kind
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def discard(*tables: DataFrame) -> None:
    """Delete the folders of written tables of one's own that nothing reads any more."""
    for written in tables:
        spark = written.sparkSession
        for file in written.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def part_count(df: DataFrame, least: int = 1) -> int:
    """Partitions for a keyed exchange of ``df``: the session's shuffle partitions."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def offsets_of_parts(totals: DataFrame, part: str, total: str, name: str) -> DataFrame:
    """Exclusive running sum of one total per partition: ``part`` and ``name``.

    ``totals`` holds one row per partition of a job, so the window without a key is a few
    thousand rows however large the input is.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(total).over(before), F.lit(0)).alias(name))
