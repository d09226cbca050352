"""Codes for the distinct values of text columns, however many there are.

Distinct values are counted with partial aggregation, sorted over ranges, and numbered by two passes of
prefix sums; no list of them ever leaves the tasks. Rows get their codes by a join. Values that hold a
large share of the rows are few by definition: they are sent to all tasks, and their rows take no part
in the exchange, so that a value with a third of all rows does not meet in one task. What is sent has a
bounded size: long values are known by their SHA-256, and where the text of a long frequent value is
wanted, copies of its entry are joined by its rows in shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.functions.columns import name
from tabwright.functions.scratch import materialise

#: Dictionaries up to this many values, and of so many bytes of text, are sent to all tasks as a whole.
SENT_WHOLE = 100_000
SENT_BYTES = 8_000_000
#: A value with more than one row in so many is sent to all tasks; there are at most so many of them.
HOT_SHARE = 1_000
#: Values of more bytes are joined by their SHA-256.
LONG_BYTES = 128
#: Bytes of values that a range sort may sample to the driver.
SAMPLED_BYTES = 32_000_000
SAMPLE_SIZE = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def _join_form(value: Column) -> Column:
    """Short text that tells values apart."""
    return F.when(F.octet_length(value) > LONG_BYTES, F.concat(F.lit("#"), F.sha2(value, 256))) \
        .otherwise(F.concat(F.lit("="), value))


@contextmanager
def _sampled(spark: SparkSession, parts: int, width: float) -> Iterator[None]:
    """Range sorts within take fewer samples where values are long: they go to the driver."""
    before = spark.conf.get(SAMPLE_SIZE)
    most = int(SAMPLED_BYTES / (3 * parts * max(1.0, width)))  # the sort takes up to three times as many
    spark.conf.set(SAMPLE_SIZE, str(max(1, min(int(before), most))))
    try:
        yield
    finally:
        spark.conf.set(SAMPLE_SIZE, before)


@dataclass
class Dictionary:
    """``entries``: ``value``, ``code`` (from 0, in the order of the UTF-8 text) and rows ``n``;
    ``bytes`` is the size of all values."""

    entries: DataFrame
    size: int
    rows: int
    bytes: int = 0

    @property
    def small(self) -> bool:
        return self.size <= SENT_WHOLE and self.bytes <= SENT_BYTES

    @classmethod
    def fit(cls, df: DataFrame, value: Column) -> "Dictionary":
        """Dictionary of the values that are not null."""
        spark = df.sparkSession
        values = df.select(value.cast("string").alias("value")).where("value is not null")
        counted = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        width = values.agg(F.avg(F.octet_length("value"))).first()[0] or 0.0
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        with _sampled(spark, parts, width):
            placed = materialise(
                counted.repartitionByRange(parts, "value").sortWithinPartitions("value")
                .withColumn("place", F.monotonically_increasing_id()), "dictionary-sorted", "zstd")
        part = F.shiftright("place", 33)
        # One row a range of the sort, whatever the number of values.
        totals = materialise(placed.groupBy(part.alias("part")).agg(
            F.count(F.lit(1)).alias("size"), F.sum("n").alias("rows"), F.min("place").alias("first"),
            F.sum(F.octet_length("value")).alias("bytes")), "dictionary-ranges")
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        shifts = materialise(totals.select("part", (F.coalesce(
            F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift")), "dictionary-shifts")
        whole = totals.agg(*[F.sum(c).alias(c) for c in ("size", "rows", "bytes")]).first()
        entries = placed.withColumn("part", part).join(F.broadcast(shifts), "part").select(
            "value", (F.col("place") + F.col("shift")).alias("code"), "n")
        return cls(entries, whole.size or 0, whole.rows or 0, whole.bytes or 0)

    def hot(self) -> DataFrame:
        """Entries of which all tasks are told: all of a small dictionary, else the frequent ones."""
        if self.small:
            return self.entries
        return self.entries.where(F.col("n") * HOT_SHARE > self.rows)

    def encode(self, df: DataFrame, column: str, output: str) -> DataFrame:
        """Adds the code of ``column`` as a long: null for null and for values not in the dictionary."""
        return self._look_up(df, _join_form(name(column).cast("string")), _join_form(F.col("value")),
                             "code", output)

    def decode(self, df: DataFrame, column: str, output: str) -> DataFrame:
        """Adds the value of the code in ``column``; null for null and for unknown codes."""
        return self._look_up(df, name(column).cast("long"), F.col("code"), "value", output)

    def _look_up(self, df: DataFrame, key: Column, given: Column, wanted: str,
                 output: str) -> DataFrame:
        kept = [c for c in df.columns if c != output]
        known, hot, copies = "dictionary key", "dictionary hot", "dictionary copies"
        # Long texts are not sent: their entry is copied, once for about every HOT_SHARE-th of the rows.
        long = F.lit(False) if wanted == "code" or self.small \
            else F.octet_length("value") > SENT_BYTES // HOT_SHARE
        share = F.ceil(F.col("n") * HOT_SHARE / F.lit(max(1, self.rows))).cast("long")
        near = self.hot().select(given.alias(known), F.when(~long, F.col(wanted)).alias(hot),
                                 F.when(long, share).otherwise(0).alias(copies))
        found = df.withColumn(known, key).join(F.broadcast(near), known, "left")
        if self.small:
            return found.select(*[name(c) for c in kept], F.col(f"`{hot}`").alias(output))
        often = long & (F.col("n") * HOT_SHARE > self.rows)
        place = F.explode(F.when(often, F.sequence(F.lit(1).cast("long"), share))
                          .otherwise(F.array(F.lit(0).cast("long"))))
        far = self.entries.select(given.alias("k"), F.col(wanted).alias("far"), place.alias("s")) \
            .select(F.struct("k", "s").alias("far key"), "far")
        # Rows that have their answer, and rows without a value, look for one that no entry has.
        settled = F.col(f"`{hot}`").isNotNull() | F.col(f"`{known}`").isNull()
        number = F.monotonically_increasing_id()
        spread = F.struct(F.col(f"`{known}`").alias("k"), F.when(settled, number + 1).when(
            F.col(f"`{copies}`") > 0, F.pmod(number, F.col(f"`{copies}`")) + 1).otherwise(0).alias("s"))
        # Rows are hashed, not sorted: they are narrower than long values, which only pass by.
        found = found.withColumn("far key", spread).hint("shuffle_hash").join(far, "far key", "left")
        return found.select(*[name(c) for c in kept],
                            F.coalesce(F.col(f"`{hot}`"), F.col("far")).alias(output))
