import datetime
import json
import zipfile

import pytest

from tabwright.config import SourceSpec
from tabwright.sources import database, files, loading, sinks
from tabwright.sources.excel import read_excel


def test_latin1_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b"name,n\ncaf\xe9,1\n")
    assert files.resolve_encoding(spark, str(tmp_path / "t.csv")) == "ISO-8859-1"
    assert files.read_csv(spark, str(tmp_path / "t.csv")).first().name == "café"


def test_utf8_csv_null_tokens_and_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        'i,x,b,s,q\n1,1.5,True,NA,"a\nb"\nNA,,False,w,"say ""hi"""\n3,NaN,True,1d,c\n')
    df = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"i": "bigint", "x": "double", "b": "boolean", "s": "string",
                               "q": "string"}
    assert [tuple(r) for r in df.collect()] == [
        (1, 1.5, True, None, "a\nb"), (None, None, False, "w", 'say "hi"'),
        (3, None, True, "1d", "c")]


def test_plain_csv_stays_splittable(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x, y"\n')
    assert not files.inspect_text(spark, str(tmp_path / "t.csv")).multi_line


def test_delimited_text(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\tb\n1\tx\n")
    spec = loading.file_source(f"{tmp_path}/t.TXT", "\\t")
    assert (spec.extension, spec.delimiter) == (".txt", "\\t")
    df = files.read_delimited(spark, str(tmp_path / "t.txt"), "\\t")
    assert tuple(df.first()) == (1, "x")


@pytest.mark.parametrize("document", [
    [{"a": 1, "b": "x"}, {"a": 2, "b": None}],
    {"a": {"0": 1, "1": 2}, "b": {"0": "x", "1": None}},
])
def test_json_tables(spark, tmp_path, document):
    (tmp_path / "t.json").write_text(json.dumps(document, indent=1))
    df = files.read_json(spark, str(tmp_path / "t.json"))
    assert df.columns == ["a", "b"]
    assert sorted((r.a, r.b) for r in df.collect()) == [(1, "x"), (2, None)]


def test_empty_and_unsupported(spark, tmp_path):
    (tmp_path / "e.csv").write_text("a,b\n")
    with pytest.raises(ValueError, match="empty"):
        loading.load(spark, loading.file_source(f"{tmp_path}/e.csv"))
    with pytest.raises(ValueError, match="unsupported"):
        loading.load(spark, loading.file_source(f"{tmp_path}/e.feather"))


def workbook(path, rows):
    """A minimal workbook: shared strings, a date style and an inline string."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    strings = ["name", "n", "day", "note"]
    cells = "".join(f'<c r="{c}1" t="s"><v>{i}</v></c>' for i, c in enumerate("ABCD"))
    body = f'<row r="1">{cells}</row>' + "".join(
        f'<row r="{i}"><c r="A{i}" t="inlineStr"><is><t>{n}</t></is></c><c r="B{i}"><v>{v}</v></c>'
        f'<c r="C{i}" s="1"><v>{d}</v></c></row>' for i, (n, v, d) in enumerate(rows, start=2))
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets>'
                      '<sheet name="S" sheetId="1" r:id="rId7"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId7" '
                      'Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(
            f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
        book.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/>'
                      '<xf numFmtId="14"/></cellXfs></styleSheet>')
        book.writestr("xl/worksheets/sheet1.xml",
                      f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_workbooks(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [("x", 1, 45292), ("y", 2.5, 45293)])
    workbook(tmp_path / "b.xlsx", [("z", 3, 45294)])
    df = read_excel(spark, str(tmp_path))
    rows = sorted(tuple(r) for r in df.collect())
    assert df.columns == ["name", "n", "day", "note"]
    assert rows == [("x", 1.0, "2024-01-01 00:00:00", None),
                    ("y", 2.5, "2024-01-02 00:00:00", None),
                    ("z", 3.0, "2024-01-03 00:00:00", None)]


def test_workbooks_with_equal_and_other_headers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tabwright.sources.excel.BATCH_ROWS", 2)
    headers = [["b", "a", "a", None], ["c", "a", "b"]]
    for i, header in enumerate(headers):
        cells = [header] + [[f"{i}{r}{c}x" for c in range(len(header))] for r in range(5)]
        rows = "".join("<row>" + "".join(
            f'<c r="{chr(65 + c)}{r + 1}" t="inlineStr"><is><t>{v}</t></is></c>'
            for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(cells))
        with zipfile.ZipFile(tmp_path / f"{'ab'[i]}.xlsx", "w") as book:
            book.writestr("xl/workbook.xml", '<workbook xmlns:r="r"><sheets>'
                          '<sheet name="s" r:id="i1"/></sheets></workbook>')
            book.writestr("xl/_rels/workbook.xml.rels", '<Relationships>'
                          '<Relationship Id="i1" Target="worksheets/s.xml"/></Relationships>')
            book.writestr("xl/worksheets/s.xml",
                          f"<worksheet><sheetData>{rows}</sheetData></worksheet>")
    df = read_excel(spark, str(tmp_path))
    # Cells beyond the last header cell belong to no column: the fourth of the first sheet has none.
    assert df.columns == ["b", "a", "a.1", "c"]
    rows = sorted((tuple(r) for r in df.collect()), key=str)
    assert rows == sorted(
        [(f"0{r}0x", f"0{r}1x", f"0{r}2x", None) for r in range(5)]
        + [(f"1{r}2x", f"1{r}1x", None, f"1{r}0x") for r in range(5)], key=str)


def test_jdbc_options():
    spec = SourceSpec(kind="database", url=database.sqlite_url("/data/x.db"), query="select 1",
                      driver="org.sqlite.JDBC", options={"fetchsize": "10000"})
    assert database.jdbc_options(spec) == {
        "url": "jdbc:sqlite:/data/x.db", "query": "select 1", "driver": "org.sqlite.JDBC",
        "fetchsize": "10000"}
    ranged = SourceSpec(kind="database", url="jdbc:x", query="select * from t", options={
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"})
    assert database.jdbc_options(ranged)["dbtable"] == "(select * from t) source_query"
    with pytest.raises(ValueError):
        database.jdbc_options(SourceSpec(kind="database", url="jdbc:x"))


def test_spec_round_trip_and_preview(spark, sf):
    spec = loading.file_source(f"{sf}/orders.parquet")
    assert SourceSpec.from_json(spec.to_json()) == spec
    shape, columns, rows = loading.preview(loading.load(spark, spec), 3)
    assert shape == (rows.sparkSession.read.parquet(spec.path).count(), 6)
    assert len(columns) == 6 and rows.count() == 3


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("k1", 1, 1, 0), ("k2", 0, 1, 1)],
                               "_row_id string, Actual int, Predicted_RF int, Predicted_KNN int")
    path = sinks.write_predictions(df, str(tmp_path))
    back = files.read_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    paths = sinks.write_metrics(df, None, str(tmp_path))
    assert len(paths) == 1 and spark.read.csv(paths[0], header=True).count() == 2
    nested = spark.createDataFrame([(datetime.date(2024, 1, 1), [1, 2])], "d date, v array<int>")
    assert spark.read.csv(sinks.write_table(nested, str(tmp_path), "n", "csv"),
                          header=True).first().v == "[1,2]"
