"""JSON documents that hold a whole table, read by many tasks.

A document is an array of records or an object of columns, ``{"column": {"row": value}}``, on one line
or many. It is read in pieces between commas, which the splits of a file give without a look at the
text before. What a split does to the reader is short: whether it leaves a string open, and by how much
it changes the depth of brackets if entered outside or inside of a string. These summaries are added up
over the splits of a file; then every split knows which of its commas part records (depth 1) or cells
(depth 2). In valid JSON no escape stands before a comma, so none reaches over pieces.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.functions.scratch import materialise, scratch_path
from tabwright.sources.records import BEGIN, END, MIDDLE, WHOLE, split_key, splits_of

#: What changes the state of a JSON reader: escapes are passed over, quotes and brackets count.
STRUCTURE = re.compile(r'\\.|["{}\[\]]')
DEEPER = {"{": 1, "[": 1, "}": -1, "]": -1}
#: Depth of the commas between records, and of those between cells.
RECORDS, CELLS = 1, 2


def scan(piece: str, inside: bool, depth: int) -> tuple[bool, int]:
    """State after a piece: whether a string is open, and the depth."""
    for found in STRUCTURE.findall(piece):
        if found == '"':
            inside = not inside
        elif not inside:
            depth += DEEPER.get(found, 0)
    return inside, depth


def pieces_of(spark: SparkSession, path: str) -> DataFrame:
    """The text between commas with its ``file`` and the start of its split, ``block``."""
    return spark.read.text(path, lineSep=",").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def summaries(pieces: DataFrame) -> DataFrame:
    """A row a split: ``turns`` (whether it opens or closes a string in all), and the change of depth
    if it is entered ``outside`` or ``inside`` a string."""
    def run(batches):
        found: dict[tuple[str, int], list] = {}
        for key, (texts,) in splits_of(batches):
            state = found.setdefault(key, [False, 0, 0])
            for text in texts:
                turned, changes = state[0], state[1:]
                for mark in STRUCTURE.findall(text):
                    if mark == '"':
                        turned = not turned
                    else:
                        changes[turned] += DEEPER.get(mark, 0)
                state[:] = turned, *changes
        files, blocks = zip(*found) if found else ((), ())
        columns = list(zip(*found.values())) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(blocks, pa.int64()), pa.array(columns[0], pa.bool_()),
             pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["file", "block", "turns", "outside", "inside"])

    return pieces.select("file", "block", "value").mapInArrow(
        run, "file string, block long, turns boolean, outside long, inside long")


def entered(found: DataFrame) -> DataFrame:
    """State in which every split is entered: ``inside`` a string or not, and ``depth``."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.col("turns").cast("int")).over(before), F.lit(0)) % 2 == 1
    change = F.when(F.col("open"), F.col("inside")).otherwise(F.col("outside"))
    return found.withColumn("open", turned).select(
        "file", "block", F.col("open").alias("inside"),
        F.coalesce(F.sum(change).over(before), F.lit(0)).alias("depth"))


def elements(pieces: DataFrame, starts: DataFrame, deepest: int) -> DataFrame:
    """Text between the commas of at most ``deepest`` brackets: ``file``, ``block``, ``number``, ``kind``
    (see `records`), the ``depth`` at which it begins, and ``value``.

    The states of all splits go to all tasks, some twenty bytes a split.
    """
    known = starts.toArrow().to_pydict()
    keys = np.array([split_key(*k) for k in zip(known["file"], known["block"])], np.uint64)
    order = np.argsort(keys)
    sent = pieces.sparkSession.sparkContext.broadcast(
        (keys[order], np.array(known["inside"], bool)[order],
         np.array(known["depth"], np.int64)[order]))

    def rows(batches):
        keys, inside_at, depth_at = sent.value
        key, parts = None, []
        for split, (texts,) in splits_of(batches):
            if split != key:
                if parts:
                    yield *key, number, BEGIN if begun else MIDDLE, began, ",".join(parts)
                at = np.searchsorted(keys, np.uint64(split_key(*split)))
                if at == len(keys) or keys[at] != split_key(*split):
                    raise RuntimeError("the files were split otherwise than when they were judged")
                inside, depth = bool(inside_at[at]), int(depth_at[at])
                key, number, parts, began = split, 0, [], depth
                begun = split[1] == 0 or (not inside and depth <= deepest)
            for text in texts:
                parts.append(text)
                inside, depth = scan(text, inside, depth)
                if not inside and depth <= deepest:
                    yield *key, number, WHOLE if begun else END, began, ",".join(parts)
                    number, parts, began, begun = number + 1, [], depth, True
        if parts:
            yield *key, number, BEGIN if begun else MIDDLE, began, ",".join(parts)

    def run(batches):
        held, size = [], 0
        for row in rows(batches):
            held.append(row)
            size += len(row[-1])
            if len(held) == 4096 or size >= 1 << 22:
                yield batch_of(held)
                held, size = [], 0
        yield batch_of(held)

    def batch_of(held):
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*held)) or [[]] * 6, kinds)],
            names=["file", "block", "number", "kind", "depth", "value"])

    return pieces.mapInArrow(
        run, "file string, block long, number long, kind int, depth long, value string")


def put_together(found: DataFrame) -> DataFrame:
    """Elements that lie in one split, and those whose parts lie in several."""
    order = Window.partitionBy("file").orderBy("block", "number")
    parts = found.where(F.col("kind") != WHOLE).withColumn(
        "element", F.count_if(F.col("kind") == BEGIN).over(order))
    first = F.struct("block", "number", "depth")
    put = parts.groupBy("file", "element").agg(F.min(first).alias("first"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "number", "value"))), lambda p: p["value"]),
        ",").alias("value"))
    return found.where(F.col("kind") == WHOLE).select(
        "file", "block", "number", "depth", "value").unionByName(
        put.select("file", "first.*", "value"))


def split_documents(spark: SparkSession, path: str, deepest: int) -> DataFrame:
    pieces = pieces_of(spark, path)
    starts = entered(materialise(summaries(pieces), "json-splits"))
    return put_together(materialise(elements(pieces, starts, deepest), "json-elements"))


def opening(spark: SparkSession, path: str) -> str | None:
    """First character of the documents, without a look at whole ones."""
    start = F.ltrim(F.col("value"), F.lit(" \t\r\n\ufeff"))
    first = (pieces_of(spark, path).where("block = 0").where(start != "")
             .select(F.substring(start, 1, 1).alias("c")).first())
    return first.c if first else None


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """Records of arrays, with the types that Spark's JSON reader finds.

    The elements are written as one line each, which Spark then reads in parallel.
    """
    text = F.regexp_replace("value", "[\r\n]+", " ")
    inner = F.regexp_replace(F.regexp_replace(text, "^[\\s\ufeff]*\\[", ""), "\\]\\s*$", "")
    # Only a document's first element has the opening bracket, and only its last the closing one.
    rows = split_documents(spark, path, RECORDS).select(F.when(
        F.col("depth") == 0, inner).otherwise(F.regexp_replace(text, "\\}\\s*\\]\\s*$", "}"))
        .alias("value")).where(F.trim("value") != "")
    lines = scratch_path(spark, "json-lines")
    rows.write.text(lines)
    return spark.read.json(lines)


DECODER = json.JSONDecoder()
BLANK = re.compile(r"[\s\ufeff]*")


def cell(text: str, depth: int) -> tuple[str | None, str | None, str | None] | None:
    """Column (if one begins here), row and value of an element that begins at this depth; no row for a
    column without cells, None for an empty document."""
    def skip(at: int) -> int:
        return BLANK.match(text, at).end()

    at, column = skip(0), None
    if depth == 0:
        at = skip(at + 1)  # the document's opening bracket
    if text[at:at + 1] != '"':
        return None
    key, at = DECODER.raw_decode(text, at)
    at = skip(skip(at) + 1)
    if depth < CELLS:
        column, at = key, skip(at + 1)
        if text[at:at + 1] != '"':
            return column, None, None
        key, at = DECODER.raw_decode(text, at)
        at = skip(skip(at) + 1)
    value, end = DECODER.raw_decode(text, at)
    return column, key, value if value is None or isinstance(value, str) else text[at:end]


def cells_of(found: DataFrame) -> DataFrame:
    """Cells of documents of columns: ``file``, ``block``, ``number``, ``column`` (where one begins, else
    null), ``row`` (null where a column has none) and ``cell`` (text; null for null)."""
    def run(batches):
        for batch in batches:
            out = []
            for file, block, number, depth, text in zip(*(c.to_pylist() for c in batch.columns)):
                read = cell(text, depth)
                if read:
                    out.append((file, block, number, *read))
            kinds = (pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 6, kinds)],
                names=["file", "block", "number", "column", "row", "cell"])

    return found.select("file", "block", "number", "depth", "value").mapInArrow(
        run, "file string, block long, number long, column string, row string, cell string")


def read_columns(spark: SparkSession, path: str) -> DataFrame:
    """Text columns of documents of columns, one row for every row key of a file.

    A cell belongs to the column that began last: in its split, or else in an earlier one.
    """
    cells = materialise(cells_of(split_documents(spark, path, CELLS)), "json-cells")
    within = Window.partitionBy("file", "block").orderBy("number")
    cells = cells.withColumn("own", F.last("column", ignorenulls=True).over(within))
    blocks = cells.groupBy("file", "block").agg(F.max_by(
        "column", F.when(F.col("column").isNotNull(), F.col("number"))).alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = blocks.select("file", "block", F.last("last", ignorenulls=True).over(before)
                            .alias("earlier"))
    named = cells.join(earlier, ["file", "block"]).select(
        "file", "row", F.coalesce("own", "earlier").alias("column"), "cell").where("row is not null")
    order = cells.where("column is not null").groupBy("column").agg(
        F.min(F.struct("file", "block", "number")).alias("first")).orderBy("first").collect()
    wide = named.groupBy("file", "row").pivot("column", [r.column for r in order]).agg(
        F.first("cell", ignorenulls=True))
    return wide.drop("file", "row")
