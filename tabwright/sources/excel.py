"""Workbooks: the first sheet of every ``.xlsx`` file of a path, read in parallel by file."""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator
from itertools import islice
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.scratch import materialise
from tabwright.sources.files import infer_types, normalise_null_tokens

# Rows of a sheet that are held at a time.
BATCH_ROWS = 2_000
# Number format ids of the file format that show dates or times.
DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _all(root: ElementTree.Element, tag: str) -> Iterator[ElementTree.Element]:
    return (e for e in root.iter() if _tag(e) == tag)


def _text(element: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in _all(element, "t"))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")) for f in _all(root, "numFmt")
              if re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")))}
    formats = next(_all(root, "cellXfs"), [])
    return {i for i, x in enumerate(formats)
            if int(x.get("numFmtId", 0)) in DATE_FORMAT_IDS | custom}


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _elements(book: zipfile.ZipFile, part: str, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of one kind, each forgotten before the next is read, whatever the part's length."""
    with book.open(part) as stream:
        events = ElementTree.iterparse(stream, events=("start", "end"))
        root = next(events)[1]
        parents = [root]
        for event, element in events:
            if event == "start":
                parents.append(element)
            else:
                parents.pop()
                if _tag(element) == tag:
                    yield element
                    parents[-1].remove(element)


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Cells of the first sheet as text, row by row; dates in ISO form."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = []
        if "xl/sharedStrings.xml" in book.namelist():
            strings = [_text(e) for e in _elements(book, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(book)
        workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
        first = next(_all(workbook, "sheet"))
        link = next(v for k, v in first.attrib.items() if k.endswith("}id"))
        links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = next(r.get("Target") for r in links if r.get("Id") == link).lstrip("/")
        part = target if target.startswith("xl/") else f"xl/{target}"
        for row in _elements(book, part, "row"):
            yield _cells(row, strings, dates)


def _cells(row: ElementTree.Element, strings: list[str], dates: set[int]) -> list[str | None]:
    cells: list[str | None] = []
    for position, cell in enumerate(_all(row, "c")):
        index = _column_index(cell.get("r")) if cell.get("r") else position
        cells += [None] * (index + 1 - len(cells))
        kind, value = cell.get("t", "n"), next(_all(cell, "v"), None)
        if kind == "inlineStr":
            cells[index] = _text(cell)
        elif value is None or kind == "e":
            cells[index] = None
        elif kind == "s":
            cells[index] = strings[int(value.text)]
        elif kind == "b":
            cells[index] = "True" if value.text == "1" else "False"
        elif kind == "n" and int(cell.get("s", 0)) in dates:
            moment = datetime.datetime(1899, 12, 30) + datetime.timedelta(days=float(value.text))
            cells[index] = moment.isoformat(sep=" ", timespec="seconds")
        else:
            cells[index] = value.text
    return cells


def header_names(cells: list[str | None]) -> list[str]:
    """Column names of a sheet: a number for an empty cell, a suffix for a name that came before."""
    names: list[str] = []
    for i, cell in enumerate(cells):
        wanted = name = cell or f"Unnamed: {i}"
        repeat = 0
        while name in names:
            repeat += 1
            name = f"{wanted}.{repeat}"
        names.append(name)
    return names


def read_excel(spark: SparkSession, path: str) -> DataFrame:
    """Union by header name of the first sheets, columns in the order of the files and their headers.

    A sheet has at most 1,048,576 rows by format, so one file fits one task; its rows pass in batches
    of BATCH_ROWS. Cells beyond the header belong to no column. Rows are written once to the shared
    folder, so the workbooks are parsed once.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path) \
        .select("path", "content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, content in zip(*(c for c in batch.columns)):
                rows = sheet_rows(content.as_py())
                header = header_names(next(rows, []))
                yield _batch(path_.as_py(), header, [])
                while records := [dict(zip(header, cells)) for cells in islice(rows, BATCH_ROWS)]:
                    yield _batch(path_.as_py(), None, records)

    parsed = materialise(files.mapInArrow(
        parse, "file string, header array<string>, record map<string,string>"), "workbooks")
    headers = parsed.where("header is not null").groupBy("header").agg(
        F.min("file").alias("file")).orderBy("file").collect()
    columns = list(dict.fromkeys(c for h in headers for c in h.header))
    if not columns:
        raise ValueError(f"no sheet with a header row under {path}")
    table = parsed.where("record is not null").select(
        *[F.try_element_at("record", F.lit(c)).alias(c) for c in columns])
    return infer_types(normalise_null_tokens(table))


def _batch(file: str, header: list[str] | None, records: list[dict]) -> pa.RecordBatch:
    rows = len(records) or 1
    kinds = pa.list_(pa.string()), pa.map_(pa.string(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * rows, pa.string()), pa.array([header] * rows, kinds[0]),
         pa.array([list(r.items()) for r in records] if header is None else [None], kinds[1])],
        names=["file", "header", "record"])
