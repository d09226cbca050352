"""Delimited files with quoted line ends, cut at arbitrary bytes, against Python's own reader."""

import csv
import random

import pytest

from tabwright.sources import files, records

PARTS = ["a", "b", '"', '""', ",", "\n", "\r\n", "\u00e9", " ", "x y", '5" pipe', "NA?"]


@pytest.fixture
def tiny_splits(spark):
    """Splits of a few hundred bytes, so that rows reach over several of them."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def write(path, rows, encoding="utf-8", ends="\n"):
    with open(path, "w", newline="", encoding=encoding) as out:
        csv.writer(out, lineterminator=ends).writerows([["id", 'a "q", b', "text"], *rows])


def random_rows(rng, first, count, most=30):
    for i in range(count):
        yield (str(first + i), *("".join(rng.choices(PARTS, k=rng.randrange(1, n)))
                                 for n in (6, most)))


def split_value(line, inside, sep):
    """The states one character at a time."""
    field, at = not inside, 0
    while at < len(line):
        if inside:
            if line[at] == '"':
                if line[at + 1:at + 2] == '"':
                    at += 1
                else:
                    inside, field = False, False
        elif field and line[at] == '"':
            inside = True
        else:
            field = line[at:at + len(sep)] == sep
            at += len(sep) - 1 if field else 0
        at += 1
    return inside


@pytest.mark.parametrize("sep", [",", "\t", "||"])
def test_states_as_one_character_at_a_time(sep):
    rng = random.Random(1)
    for _ in range(20_000):
        line = "".join(rng.choices(["a", '"', '""', sep, " ", "|"], k=rng.randrange(9)))
        for inside in (False, True):
            assert records.state_after(line, inside, sep) == split_value(line, inside, sep), line


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_rows_over_many_splits(spark, tmp_path, tiny_splits, ends):
    rng = random.Random(len(ends))
    rows = []
    for f, encoding in enumerate(("utf-8", "latin-1", "utf-8")):
        mine = list(random_rows(rng, f * 1000, 150, 60))
        mine.append((str(f * 1000 + 999), "x", "long\n" * 400))
        write(tmp_path / f"{f}.csv", mine, encoding, ends)
        rows += mine
    df = records.read_records(spark, str(tmp_path), ",")
    assert df.columns == ["id", 'a "q", b', "text"]
    assert sorted(tuple(r) for r in df.collect()) == sorted(rows)
    splits = records.raw_lines(spark, str(tmp_path)).select("file", "block").distinct().count()
    assert splits > 20


def test_starts_of_splits_inside_quotes(spark, tmp_path, tiny_splits):
    write(tmp_path / "t.csv", [("1", "x", "in\n" * 500), ("2", "y", "z")])
    lines = records.raw_lines(spark, str(tmp_path))
    starts = records.start_states(records.split_maps(lines, ",")).orderBy("block").collect()
    assert [r.start for r in starts][:2] == [False, True] and len(starts) > 4
    assert all(r.start for r in starts[1:]) and not any(r.latin for r in starts)


def test_reader_takes_several_tasks_and_infers_types(spark, tmp_path, tiny_splits):
    rows = [(str(i), "NA" if i % 3 else "w", f"line\n{i}") for i in range(200)]
    write(tmp_path / "t.csv", rows)
    assert files.inspect_text(spark, str(tmp_path)).multi_line
    df = files.read_csv(spark, str(tmp_path))
    assert dict(df.dtypes)["id"] == "bigint"
    assert df.rdd.getNumPartitions() > 1
    got = sorted((r.id, r['a "q", b'], r.text) for r in df.collect())
    assert got == sorted((int(i), None if a == "NA" else a, t) for i, a, t in rows)


def test_odd_files(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b'\xef\xbb\xbfid,,ID\r\n\r\n1,"a\r\nb"\r\n2,"",x,more\n3,"open\nend')
    df = records.read_records(spark, str(tmp_path), ",")
    assert df.columns == ["id0", "_c1", "ID2"]
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", "a\r\nb", None), ("2", None, "x"), ("3", "open\nend", None)]
    (tmp_path / "u.csv").write_text("other,names\n1,2\n")
    with pytest.raises(ValueError, match="different header"):
        records.read_records(spark, str(tmp_path), ",")
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("")
    assert records.read_records(spark, str(tmp_path / "empty"), ",").columns == []


def test_encodings_of_a_folder(spark, tmp_path):
    (tmp_path / "u.csv").write_text("name,n\ncaf\u00e9,1\n", encoding="utf-8")
    (tmp_path / "l.csv").write_text("name,n\ncaf\u00e9,2\n", encoding="latin-1")
    found = {r.file.rsplit("/", 1)[1]: r.encoding
             for r in files.file_encodings(spark, str(tmp_path)).collect()}
    assert found == {"u.csv": "UTF-8", "l.csv": "ISO-8859-1"}
    assert files.resolve_encoding(spark, str(tmp_path)) is None
    assert sorted(tuple(r) for r in files.read_csv(spark, str(tmp_path)).collect()) == [
        ("caf\u00e9", 1), ("caf\u00e9", 2)]
