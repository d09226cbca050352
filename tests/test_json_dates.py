import hashlib
import random
import datetime

import pytest
from pyspark.sql import functions as F

from tabwright.config import DATE_FORMATS
from tabwright.functions.texts import json_scalar, parse_datetime
from tabwright.operators import datetimes, jsoncol


@pytest.mark.parametrize("text,expected", [
    ('{"name": "x", "k": 1}', "x"), ("{'name': 'y'}", "y"), ('{"b": 1, "a": 2}', "1"),
    ('{"k": 1,}', "1"), ("{}", "{}"), ("{bad}", "{bad}"), ("plain", "plain"), (' {"k":2} ', "2"),
    (None, None), ('{"name": null, "k": 1}', None), ('{"k":1,} ', '{"k":1,}'),
    ('{"k": {"z":1}}', '{"z":1}'), ('{"b":1,"b":3}', "3"), (" plain ", " plain "),
    ('{"k": 1} x}', "1"),
])
def test_json_scalar(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(json_scalar(F.col("v")).alias("s")).first().s == expected


def test_json_columns_found_and_typed(spark):
    df = spark.createDataFrame([('{"k": 1}', "a", '{"k": "w"}'), (None, "b", "x")],
                               "n string, t string, w string")
    assert jsoncol.json_like_columns(df) == ["n", "w"]
    flat = jsoncol.flatten_json_columns(df)
    assert dict(flat.dtypes) == {"n": "double", "t": "string", "w": "string"}


def test_text_dates(spark):
    days = [f"2024-01-{d:02d}" for d in range(1, 20)]
    df = spark.createDataFrame([(d, d if i % 2 else "word", str(20240100 + i), "12.5")
                                for i, d in enumerate(days)] + [(None, None, None, None)],
                               "iso string, mixed string, digits string, number string")
    assert datetimes.probe_datetime_strings(df) == ["iso"]


def test_probe_decides_by_the_sampled_values(spark):
    """A rare bad value outside the sample leaves the column a date column."""
    df = spark.range(3000).select(F.when(F.col("id") == 7, "unreadable 1-1").otherwise(
        F.date_format(F.date_add(F.lit("2000-01-01"), F.col("id").cast("int")), "yyyy-MM-dd"))
        .alias("d"))
    sample = (df.orderBy(F.md5(F.concat(F.lit("42:"), "d").cast("binary"))).limit(50)
              .where(parse_datetime(F.col("d"), DATE_FORMATS).isNull()).count())
    assert (datetimes.probe_datetime_strings(df) == ["d"]) == (sample == 0)
    assert datetimes.probe_datetime_strings(df, sample=3000) == []


@pytest.mark.parametrize("text,expected", [
    ("2024-01-02", datetime.datetime(2024, 1, 2)),
    ("2024-01-02 03:04", datetime.datetime(2024, 1, 2, 3, 4)),
    ("2024-01-02T03:04:05", datetime.datetime(2024, 1, 2, 3, 4, 5)),
    ("01/02/2024", datetime.datetime(2024, 1, 2)), ("2-Jan-2024", None),
    ("02-Jan-2024", datetime.datetime(2024, 1, 2)), ("Jan 2, 2024", datetime.datetime(2024, 1, 2)),
    ("20240102", None), ("2024", None), ("words", None), ("2024-13-40", None),
])
def test_parse_datetime(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(parse_datetime(F.col("v"), DATE_FORMATS).alias("t")).first().t == expected


def test_parts_monday_and_midnight(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1),), (datetime.datetime(2024, 1, 7),),
                                (None,)], "d timestamp_ntz")
    out = datetimes.extract_datetime_features(df)
    assert out.columns == ["d_year", "d_month", "d_day", "d_dayofweek"]
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [(2024.0, 1.0, 1.0, 0.0), (2024.0, 1.0, 4.0, 3.0), (2024.0, 1.0, 7.0, 6.0)]


def test_all_missing_date_column_dropped_and_clash_raises(spark):
    df = spark.createDataFrame([(1, None)], "a int, d date")
    assert datetimes.extract_datetime_features(df).columns == ["a"]
    clash = spark.createDataFrame([(1, datetime.date(2024, 1, 1))], "d_year int, d date")
    with pytest.raises(ValueError, match="d_year"):
        datetimes.extract_datetime_features(clash)


def test_probe_as_a_sort_of_all_values(spark, monkeypatch):
    """Few and many different values, unreadable ones at every place of the order."""
    rng = random.Random(2)
    days = [f"2024-01-{d:02d} 10:00:00" for d in range(1, 29)]
    columns = {}
    for k, (kinds, bad) in enumerate([(3, 0.0), (28, 0.02), (28, 0.3), (5000, 0.0), (5000, 0.001),
                                      (5000, 0.02), (5000, 1.0)]):
        pool = [f"20{rng.randrange(10, 99)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)} "
                f"{rng.randrange(10, 23)}:{rng.randrange(10, 59)}:00" if kinds > 28 else days[j]
                for j in range(kinds)]
        columns[f"c{k}"] = [f"no date {rng.randrange(900)}" if rng.random() < bad else
                            rng.choice(pool) if rng.random() < 0.95 else None for _ in range(3000)]
    columns["empty"] = [None] * 3000
    names = list(columns)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{n} string" for n in names))
    for sample in (1, 20, 50, 400):
        wanted = []
        for n in names:
            ranked = sorted((hashlib.md5(f"42:{v}".encode()).hexdigest(), v)
                            for v in columns[n] if v is not None)
            taken = [h for h, v in ranked if v.startswith("no")]
            ahead = sum(h < taken[0] for h, _ in ranked) if taken else len(ranked)
            if ranked and (not taken or ahead >= sample):
                wanted.append(n)
        for room in (8, 2):
            monkeypatch.setattr(datetimes, "ROOM", room)
            assert datetimes.probe_datetime_strings(df, names, sample=sample) == wanted
