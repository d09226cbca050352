"""Shared working folder: where intermediate tables are written and read back."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tabwright.functions.columns import name


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else the context's checkpoint folder; a fresh
    local one only where neither is set and all tasks run on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tabwright-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    The copy cuts the lineage, survives lost executors and lets later steps read only the
    columns they need. ``compression`` replaces the session's codec.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def ordered_by_key(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Rows hashed by key over all task slots and sorted within each partition.

    Fits that depend on the row order then give the same result however the input was
    partitioned, and a small input still uses every core.
    """
    spark = df.sparkSession
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                spark.sparkContext.defaultParallelism)
    keys = [name(c) for c in key_cols]
    return df.repartition(slots, *keys).sortWithinPartitions(*keys)
