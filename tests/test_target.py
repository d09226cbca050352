import pytest

from catalog.targets import COLUMNS, expanded
from tabwright.operators import target
from tabwright.operators.profile import profile_columns

C, R = "classification", "regression"


@pytest.mark.parametrize("kind,values,expected", [
    ("boolean", [True, False, True], C), ("int", [0, 1, 0], C), ("double", [1.5, 2.5], C),
    ("int", [i % 10 for i in range(1000)], C),
    ("double", [(i % 10) / 10 for i in range(1000)], R), ("int", list(range(200)), R),
    ("string", ["a", "b"], C),
])
def test_task_types(spark, kind, values, expected):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    assert target.detect_task_type(df, "v") == expected
    assert target.task_types(df).first().task_type == expected


def test_name_order_beats_column_order(spark):
    df = spark.createDataFrame([(i % 3, i % 4, i % 2) for i in range(50)],
                               "Score int, label int, other int")
    assert target.choose_target(df) == "label"


def test_id_like_names(spark):
    df = spark.createDataFrame([(i % 5, i % 5, i % 5, i % 5) for i in range(50)],
                               "paid int, width int, risk int, x int")
    names = [r.column_name for r in target.target_candidates(profile_columns(df)).collect()]
    assert names == ["x"]


def test_exact_pattern_name_stays(spark):
    df = spark.createDataFrame([(i % 10, i) for i in range(100)], "number int, row int")
    assert target.choose_target(df) == "number"


def test_no_candidate_raises(spark):
    with pytest.raises(ValueError):
        target.choose_target(spark.createDataFrame([(1, "a"), (1, "a")], "x int, y string"))


def test_resolve_order(spark):
    df = spark.createDataFrame([(i % 2, i % 3) for i in range(60)], "a int, b int")
    assert target.resolve_target(df, "b", "a") == "b"
    assert target.resolve_target(df, "gone", "b") == "b"
    assert target.resolve_target(df, None, "gone") == "a"


EXPECTED = {
    "region": "r_name", "nation": "n_name", "customer": "c_mktsegment", "supplier": "s_name",
    "part": "p_type", "orders": "o_orderstatus", "lineitem": "l_linestatus",
    "events": "event_type", "documents": "lang", "pages": "url", "benchmark": "text",
    "labels": "quality", "conversations": "role",
}


@pytest.mark.parametrize("table", ["supplier", "orders", "events", "labels", "pages"])
def test_expected_targets(spark, table):
    assert table in COLUMNS
    df = expanded(spark, "/root/testdata/sf0.01", table)
    assert target.choose_target(df) == EXPECTED[table]


def test_codes_and_texts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "y string")
    encoded, encoding = target.label_encode(df, "y")
    assert [(r.y, r.label) for r in encoded.orderBy("y").collect()] == [
        ("a", 0), ("a", 0), ("b", 1), ("c", 2)]
    decoded = target.label_decode(encoded, encoding, ["label"])
    assert decoded.where("y <> label_Original").count() == 0
