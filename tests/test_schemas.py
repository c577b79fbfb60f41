"""Readers of the input tables: types, quarantine, missing columns."""

import pytest

from runsight.session import scratch_dir
from runsight.sources import schemas as SC


def test_bad_values_are_quarantined(spark):
    path = scratch_dir(spark, "ci")
    lines = ['{"created_at": "2024-01-01T00:00:00", "conclusion": "failure", "name": "a", "more": 1}',
             '{"created_at": "soon", "conclusion": "failure", "name": "b"}', '{"conclusion": "success", "name": "c"}', '{"created_at',
             '{"created_at": "2024-01-02T00:00:00", "conclusion": "success"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = SC.read(spark, "ci_runs", path)
    assert got.columns == ["created_at", "conclusion", "name", "quarantined"]
    assert got.filter("quarantined").count() == 3
    assert sorted((r.conclusion, r.name) for r in SC.read_good(spark, "ci_runs", path).collect()) == [
        ("failure", "a"), ("success", None)]


def test_parquet_of_other_types_and_columns(spark):
    df = spark.createDataFrame([("j", "12", None), ("k", "many", None), (None, "1", None)], "job_name string, normal_rows string, x int")
    rows = {r.job_name: r for r in SC.conform(df, "registry").collect()}
    assert rows["j"].normal_rows == 12 and not rows["j"].quarantined and rows["j"].depends_on is None
    assert rows["k"].normal_rows is None and rows["k"].quarantined
    assert rows[None].quarantined
    with pytest.raises(ValueError):
        SC.conform(df.drop("job_name"), "registry")
    assert SC.conform(df.limit(0), "registry").count() == 0


def test_every_schema_parses():
    for table, (_, needed) in SC.TABLES.items():
        assert set(needed) <= set(SC.schema_of(table).names)
