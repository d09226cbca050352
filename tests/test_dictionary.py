"""Codes of text values: order, look-ups both ways, hot values, missing and unseen values."""

import random

import pytest
from pyspark.sql import functions as F

from tabwright.operators import dictionary, features, target
from tabwright.operators.dictionary import Dictionary


@pytest.fixture(params=[100_000, 3])
def sent_whole(request, monkeypatch):
    """Dictionaries sent to all tasks, and such that are joined."""
    monkeypatch.setattr(dictionary, "SENT_WHOLE", request.param)
    monkeypatch.setattr(target, "SENT_WHOLE", request.param)
    monkeypatch.setattr(dictionary, "HOT_SHARE", 5)


def values():
    rng = random.Random(1)
    return ["hot"] * 400 + [rng.choice(["a", "\u00e9", "Z", "", "\U0001f600", "zz"]) + str(i % 90)
                            for i in range(600)] + [None] * 50


def test_codes_and_values(spark, sent_whole):
    rows = list(enumerate(values()))
    df = spark.createDataFrame(rows, "i long, v string").repartition(5)
    made = Dictionary.fit(df, F.col("v"))
    order = sorted({v for _, v in rows if v is not None}, key=str.encode)
    assert (made.size, made.rows) == (len(order), 1000)
    coded = made.encode(df, "v", "code")
    assert {r.i: (r.v, r.code) for r in coded.collect()} == {
        i: (v, None if v is None else order.index(v)) for i, v in rows}
    back = made.decode(coded, "code", "again")
    assert back.columns == ["i", "v", "code", "again"]
    assert back.count() == len(rows) and back.where("not (v <=> again)").isEmpty()
    other = spark.createDataFrame([("new",), ("hot",), (None,)], "v string")
    assert sorted(str(r.c) for r in made.encode(other, "v", "c").collect()) == sorted(
        ["None", str(order.index("hot")), "None"])


def test_rows_of_a_hot_value_are_not_exchanged_by_it(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "SENT_WHOLE", 3)
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(
        F.col("id").cast("string")).alias("v"))
    made = Dictionary.fit(df, F.col("v"))
    assert [r.value for r in made.hot().collect()] == ["hot"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = made.encode(df, "v", "c").groupBy(F.spark_partition_id().alias("p")).count()
        most = parts.agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert most < 20_000 / 4 * 1.3


def test_targets_with_many_classes(spark, sent_whole):
    rows = [(v,) for v in values() if v is not None]
    encoded, encoding = target.label_encode(spark.createDataFrame(rows, "y string"), "y")
    order = sorted({v for v, in rows}, key=str.encode)
    assert encoding.coded
    assert sorted((r.y, r.label) for r in encoded.collect()) == sorted(
        (v, order.index(v)) for v, in rows)
    decoded = target.label_decode(encoded, encoding, ["label"])
    assert decoded.where("y <> label_Original").isEmpty()
    with pytest.raises(Exception, match="(?i)unseen|no class"):
        encoding.transform(spark.createDataFrame([("unseen",)], "y string")).collect()


def test_level_codes_of_features(spark, sent_whole):
    df = spark.createDataFrame([("b", True), (None, None), ("a", False), ("b", None)],
                               "s string, t boolean")
    coded, made = features.level_codes(df, ["s", "t"])
    names = {c: [r.value for r in d.entries.orderBy("code").collect()] for c, d in made.items()}
    assert all(v == sorted(v) for v in names.values())
    for r in coded.collect():
        assert names["s"][r.s_code] == (r.s or features.MISSING_LEVEL)
        assert names["t"][r.t_code] == (features.MISSING_LEVEL if r.t is None else str(r.t))


def test_empty_and_null_only(spark, sent_whole):
    df = spark.createDataFrame([(None,)], "v string")
    made = Dictionary.fit(df, F.col("v"))
    assert made.size == 0 and made.encode(df, "v", "c").first().c is None


@pytest.mark.parametrize("limit,out", [(39, ["v"]), (40, []), (41, [])])
def test_limits_of_levels_are_exact(spark, limit, out):
    rows = [(f"x{i % 39}" if i else None, "k") for i in range(400)]  # 39 levels and the stand-in
    df = spark.createDataFrame(rows, "v string, w string")
    assert list(features.wide_categoricals(df, ["v", "w"], limit)) == out


@pytest.fixture
def few_bytes(monkeypatch):
    """Texts count as long from 20 bytes on, and 200 bytes are too many to send."""
    monkeypatch.setattr(dictionary, "LONG_BYTES", 20)
    monkeypatch.setattr(dictionary, "SENT_BYTES", 200)
    monkeypatch.setattr(target, "SENT_BYTES", 200)
    monkeypatch.setattr(dictionary, "HOT_SHARE", 5)


def test_few_long_texts_are_not_collected(spark, few_bytes):
    texts = [("x" * 100 + str(i % 40)) if i % 3 else "hot " * 60 for i in range(600)] + ["short"] * 300
    df = spark.createDataFrame(list(enumerate(texts)), "i long, y string").repartition(4)
    encoded, encoding = target.label_encode(df, "y")
    order = sorted(set(texts))
    assert encoding.classes is None and encoding.dictionary.bytes == sum(map(len, order))
    assert {r.i: r.label for r in encoded.collect()} == {i: order.index(t) for i, t in enumerate(texts)}
    decoded = target.label_decode(encoded, encoding, ["label"])
    assert {r.i: r.label_Original for r in decoded.collect()} == dict(enumerate(texts))


def test_sorts_of_long_texts_sample_less(spark):
    before = spark.conf.get(dictionary.SAMPLE_SIZE)
    with dictionary._sampled(spark, 600, 3_000.0):
        assert spark.conf.get(dictionary.SAMPLE_SIZE) == "5"
    assert spark.conf.get(dictionary.SAMPLE_SIZE) == before
