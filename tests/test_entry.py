"""Driver contract."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 200
    assert "keywords" in df.columns and "topics" in df.columns


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 50
