"""JSON documents cut at arbitrary bytes, against Python's own reader."""

import json
import random

import pytest

from tabwright.sources import documents, files

TEXTS = ["a", "x, y", 'say "hi"', "[1, {", "}]", "back\\slash", "é\n\t", "", "\\\"", "{\"k\": 1}, "]


@pytest.fixture
def tiny_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def random_records(rng, count):
    return [{"id": i, "t": "".join(rng.choices(TEXTS, k=rng.randrange(8))),
             "n": rng.choice([None, 1.5, -2.0]), "deep": {"l": [i, i + 1], "s": rng.choice(TEXTS)}}
            for i in range(count)]


@pytest.mark.parametrize("indent", [None, 1])
def test_arrays_of_records(spark, tmp_path, tiny_splits, indent):
    rng = random.Random(2)
    wanted = []
    for f in range(2):
        rows = random_records(rng, 120)
        wanted += rows
        (tmp_path / f"{f}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=f == 0))
    df = files.read_json(spark, str(tmp_path))
    key = lambda r: (r["id"], json.dumps(r, sort_keys=True))
    got = [r.asDict(recursive=True) for r in df.select("id", "t", "n", "deep").collect()]
    assert sorted(got, key=key) == sorted(wanted, key=key)
    assert documents.pieces_of(spark, str(tmp_path)).select("file", "block").distinct().count() > 20


@pytest.mark.parametrize("indent", [None, 2])
def test_objects_of_columns(spark, tmp_path, tiny_splits, indent):
    rng = random.Random(3)
    names = ["id", "a, \"b\"", "t{", "none", "z"]
    wanted = []
    for f in range(2):
        table = {n: {} for n in names}
        for i in range(90):
            row = (f * 1000 + i, rng.choice(TEXTS[:6]), "".join(rng.choices(TEXTS, k=4)) + ".", i / 4)
            wanted.append(row)
            for n, v in zip(("id", "a, \"b\"", "t{", "z"), row):
                table[n][str(i)] = v
        (tmp_path / f"{f}.json").write_text(json.dumps(table, indent=indent))
    df = files.read_json(spark, str(tmp_path))
    assert df.columns == names
    assert dict(df.dtypes)["id"] == "bigint" and dict(df.dtypes)["z"] == "double"
    got = sorted((r[0], r[1], r[2], r[4]) for r in df.collect())
    assert got == sorted(wanted)


def test_states_of_pieces():
    rng = random.Random(5)
    for _ in range(300):
        text = json.dumps(random_records(rng, 3))
        inside, depth = False, 0
        for piece in text.split(","):
            inside, depth = documents.scan(piece, inside, depth)
        assert (inside, depth) == (False, 0)


@pytest.mark.parametrize("text,rows", [
    ("[]", []), (" [ {\"a\": 1} ] \n", [(1,)]), ('[{"a":1},\n{"a":2}]', [(1,), (2,)]),
    ('{"a": {}}', []), ('{"a": {"0": "x"}}', [("x",)]), ('{ "a" : { "0" : 7 , "1" : null } }', [(7,), (None,)])])
def test_small_documents(spark, tmp_path, text, rows):
    (tmp_path / "t.json").write_text(text)
    df = files.read_json(spark, str(tmp_path / "t.json"))
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(rows, key=str)
