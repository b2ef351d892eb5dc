import __spark_entry__ as entry


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["host", "n_titles", "n_pages"]
    assert df.count() > 0


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
