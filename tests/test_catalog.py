import __spark_entry__ as entry


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["class_name", "precision", "recall", "f1", "support"]
    assert df.count() == 5
