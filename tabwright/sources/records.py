"""Delimited text with quoted line ends, read by many tasks.

Lines come from the file's splits. Whether a line end closes a row depends on whether it stands inside
quotes, which a split alone cannot know. So every split becomes a map over the two states, outside and
inside a quoted value; the maps of a file compose in order, which gives each split the state it starts
in, and a second pass cuts it at its true row ends. Only the pieces of rows that reach over splits, two
a split at most, are brought together.

Encodings are decided file by file: a file whose lines are not all valid UTF-8 is ISO-8859-1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.scratch import materialise

#: Lines of one Arrow batch that are turned into Python strings at a time.
SLICE_ROWS = 1024
OUTSIDE, INSIDE = False, True


def state_after(line: str, inside: bool, sep: str) -> bool:
    """Whether a quoted value is open after the line. A quote opens a value at its very start only,
    and two quotes in a quoted value are one."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside and line.startswith('"', at):
            inside, at = INSIDE, at + 1
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('""', at):
                at = line.find('"', at + 2)
            if at < 0:
                return INSIDE
            inside, at = OUTSIDE, at + 1
        at = line.find(sep, at)
        if at < 0:
            return OUTSIDE
        at += len(sep)


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as bytes in a text column, with their ``file`` and the start of their split, ``block``."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def latin(value: str) -> Column:
    return F.decode(F.col(value).cast("binary"), "ISO-8859-1")


def splits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list]]:
    """File and block of neighbouring lines, and the values of the further columns in lists."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            files, blocks, *more = (c.to_pylist() for c in part.columns)
            first = 0
            for i in range(1, len(files) + 1):
                if i == len(files) or files[i] != files[first] or blocks[i] != blocks[first]:
                    yield (files[first], blocks[first]), [m[first:i] for m in more]
                    first = i


def split_maps(lines: DataFrame, sep: str) -> DataFrame:
    """A row a split: ``file``, ``block``, the states after it when entered ``outside`` and ``inside``
    of a quoted value, and whether its lines are valid UTF-8."""
    def run(batches):
        found: dict[tuple[str, int], list[bool]] = {}
        for key, (texts, valid) in splits_of(batches):
            state = found.setdefault(key, [OUTSIDE, INSIDE, True])
            for text in texts:
                if '"' in text:
                    state[0] = state_after(text, state[0], sep)
                    state[1] = state_after(text, state[1], sep)
            state[2] = state[2] and all(valid)
        files, blocks = zip(*found) if found else ((), ())
        columns = list(zip(*found.values())) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(blocks, pa.int64()),
             *[pa.array(c, pa.bool_()) for c in columns]],
            names=["file", "block", "outside", "inside", "utf8"])

    # Quotes and separators are the same bytes in both encodings; the other bytes do not matter here.
    checked = lines.select("file", "block", latin("value").alias("value"),
                           F.is_valid_utf8("value").alias("valid"))
    return checked.mapInArrow(
        run, "file string, block long, outside boolean, inside boolean, utf8 boolean")


def start_states(maps: DataFrame) -> DataFrame:
    """Every split with ``start``, the state it is entered in, and ``latin``, its file's encoding.

    A map either forgets the state it is entered in, keeps it or turns it round. The state before a
    split is that of the last split that forgets, turned as often as the splits since then turn.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    forgets = F.col("outside") == F.col("inside")
    turned = maps.withColumn("turns", F.sum(F.when(~forgets & F.col("outside"), 1).otherwise(0))
                             .over(upto))
    known = F.when(forgets, F.struct(F.col("outside").cast("int").alias("state"), "turns"))
    last = F.last(known, ignorenulls=True).over(before)
    state = (F.coalesce(last["state"], F.lit(0)) + F.coalesce(F.lag("turns").over(
        Window.partitionBy("file").orderBy("block")), F.lit(0)) - F.coalesce(last["turns"], F.lit(0)))
    return turned.select("file", "block", (state % 2 == 1).alias("start"),
                         (~F.bool_and("utf8").over(Window.partitionBy("file"))).alias("latin"))


def split_key(file: str, block: int) -> int:
    return xxhash.xxh64_intdigest(f"{block}:{file}")


#: A row of text within a split, the end of one begun before, the beginning of one, a piece between.
WHOLE, END, BEGIN, MIDDLE = range(4)


def pieces(lines: DataFrame, starts: DataFrame, sep: str) -> DataFrame:
    """Rows and pieces of rows of every split: ``file``, ``block``, ``number`` in it, ``kind``,
    ``header`` (first row of a file) and ``value``.

    The starts of all splits go to all tasks: ten bytes for a split, less than a millionth of the text
    at the usual size of splits.
    """
    found = starts.toArrow().to_pydict()
    keys = np.array([split_key(*k) for k in zip(found["file"], found["block"])], np.uint64)
    order = np.argsort(keys)
    sent = lines.sparkSession.sparkContext.broadcast(
        (keys[order], np.array(found["start"], bool)[order], np.array(found["latin"], bool)[order]))

    def rows(batches):
        key, parts = None, []
        keys, start, latin = sent.value

        def piece(kind: int):
            nonlocal parts, number, headed
            text = "\n".join(parts)
            if kind in (WHOLE, END):
                text = text.removesuffix("\r")
            header = not headed and bool(text.strip())
            headed, number, parts = headed or header, number + 1, []
            return *key, number, kind, header, text

        for split, (values,) in splits_of(batches):
            if split != key:
                if parts:
                    yield piece(BEGIN if begun else MIDDLE)
                at = np.searchsorted(keys, np.uint64(split_key(*split)))
                if at == len(keys) or keys[at] != split_key(*split):
                    raise RuntimeError("the files were split otherwise than when they were judged")
                key, number, headed = split, 0, split[1] > 0
                state, begun = bool(start[at]), not start[at]
                code = "latin-1" if latin[at] else "utf-8"
            for value in values:
                line = value.decode(code)
                parts.append(line)
                state = state_after(line, state, sep)
                if state == OUTSIDE:
                    yield piece(WHOLE if begun else END)
                    begun = True
        if parts:
            yield piece(BEGIN if begun else MIDDLE)

    def run(batches):
        held, size = [], 0
        for row in rows(batches):
            held.append(row)
            size += len(row[-1])
            if len(held) == 4096 or size >= 1 << 22:
                yield batch_of(held)
                held, size = [], 0
        yield batch_of(held)

    return lines.select("file", "block", F.col("value").cast("binary").alias("value")).mapInArrow(
        run, "file string, block long, number long, kind int, header boolean, value string")


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 6, types)],
        names=["file", "block", "number", "kind", "header", "value"])


def joined(found: DataFrame) -> DataFrame:
    """All rows of text (``file``, ``header``, ``value``): whole ones, and those put together."""
    order = Window.partitionBy("file").orderBy("block", "number")
    parts = found.where(F.col("kind") != WHOLE).withColumn(
        "row", F.count_if(F.col("kind") == BEGIN).over(order))
    put = parts.groupBy("file", "row").agg(
        F.bool_or("header").alias("header"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "number", "value"))),
                                 lambda p: p["value"]), "\n").alias("value"))
    return found.where(F.col("kind") == WHOLE).select("file", "header", "value").unionByName(
        put.select("file", "header", "value"))


def fields(record: str, sep: str) -> list[str]:
    """Values of one row of text."""
    out, at = [], 0
    while True:
        if record.startswith('"', at):
            end = record.find('"', at + 1)
            while end >= 0 and record.startswith('""', end):
                end = record.find('"', end + 2)
            end = len(record) if end < 0 else end
            value, at = record[at + 1:end].replace('""', '"'), end + 1
        else:
            value = ""
        end = record.find(sep, at)
        out.append(value + (record[at:] if end < 0 else record[at:end]))
        if end < 0:
            return out
        at = end + len(sep)


def column_names(header: list[str]) -> list[str]:
    """Names as Spark's reader makes them: a number for a missing name, one more for a repeated one."""
    lower = [h.lower() for h in header]
    return [f"_c{i}" if not h else f"{h}{i}" if lower.count(h.lower()) > 1 else h
            for i, h in enumerate(header)]


def read_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Text columns of delimited files whose quoted values may hold line ends, one encoding a file.

    The rows are written once to the shared folder, so that every later step reads them in parallel
    whatever the splits of the files. Files must have the same header row; blank lines are no rows.
    """
    lines = raw_lines(spark, path)
    maps = materialise(split_maps(lines, sep), "records-maps")
    rows = joined(materialise(pieces(lines, start_states(maps), sep), "records-rows"))
    headers = rows.where("header").groupBy("value").agg(F.min("file").alias("file")) \
        .orderBy("file").limit(2).collect()
    if not headers:
        return spark.createDataFrame([], T.StructType([]))
    if len(headers) > 1:
        raise ValueError(f"different header rows in {headers[0].file} and {headers[1].file}")
    names = column_names(fields(headers[0].value.removeprefix("\ufeff"), sep))
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    data = rows.where(~F.col("header") & (F.trim("value") != "")).select(
        F.from_csv("value", schema, options).alias("row"))
    return data.select("row.*")
