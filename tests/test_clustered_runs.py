"""Runs that land are shuffled once on their way to their results; a replay shuffles the known rows to them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from runsight.operators.asof import asof_join
from runsight.operators.chunked import bounds
from runsight.plans import pipeline
from runsight.sources import files as IO

T0 = datetime(2024, 1, 1)


def _hash_exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _sides(spark):
    left = spark.createDataFrame([(f"j{i % 3}", f"r{i}", T0 + timedelta(minutes=i)) for i in range(30)],
                                 "job string, id string, at timestamp")
    right = spark.createDataFrame([("j0", T0, 1), ("j0", T0, 3), ("j0", T0, None), ("j1", T0 + timedelta(minutes=5), 2)],
                                  "job string, seen timestamp, v long")
    return left, right


def test_asof_rows_stay_clustered_by_key(spark):
    left, right = _sides(spark)
    near = asof_join(left, right, "job", "at", "seen", ["v"], all_known=True)
    assert near.columns == ["job", "id", "at", "v"]
    one = IO.newest(near, ["job", "id", "at"], ["v"])
    assert _hash_exchanges(one) == 1
    got = {r["id"]: (r["job"], r["at"], r["v"]) for r in one.collect()}
    assert got == {f"r{i}": (f"j{i % 3}", T0 + timedelta(minutes=i), [3, 2 if i >= 5 else None, None][i % 3]) for i in range(30)}


def test_known_rows_come_to_clustered_rows(spark):
    left, right = _sides(spark)
    new = IO.newest(asof_join(left, right, "job", "at", "seen", ["v"], all_known=True), ["job", "id", "at"], ["v"])
    seen = left.select(F.col("job").alias("j"), F.col("id").alias("i"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with IO.clustering_kept(spark):
            both = new.join(seen, (F.col("job") == F.col("j")) & F.col("id").eqNullSafe(F.col("i")), "left")
            assert _hash_exchanges(both) == 2
            assert both.count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_hot_key_is_known_without_a_written_count(spark, monkeypatch):
    from runsight.operators import chunked
    rows = spark.range(100).select((F.col("id") % 50).alias("k"), F.col("id").alias("x"))
    monkeypatch.setattr(chunked, "_written", lambda *a: (_ for _ in ()).throw(AssertionError("keys were counted")))
    assert bounds(rows, "k", ["x"], 20) is None


def test_runs_without_an_id_land_once(spark, tmp_path):
    """Equal runs of a job with a NULL run_id, a corrected copy and a replay of the first extract."""
    reg = spark.createDataFrame([("a", "t", "high", 40.0, 7)], "job_name string, team string, impact string, sla_minutes double, normal_rows long")
    res = spark.createDataFrame([("a", T0 + timedelta(hours=2), 11)], "job_name string, recorded_at timestamp, rows_processed long")
    schema = "dag_id string, run_id string, start_date timestamp, duration double, state string"
    rows = [("a", None, T0, 60.0, "success"), ("a", "x", T0, 120.0, "success"), ("a", "y", T0 + timedelta(hours=3), 60.0, "success"),
            ("b", "z", T0, 60.0, "success"), ("a", "w", T0, None, "success")]
    fixed = [("a", None, T0, 180.0, "success")]
    path, done = f"{tmp_path}/silver", False
    for records, hours in ((rows, 4), (fixed, 5), (rows, 4)):
        out = pipeline.land_runs(spark.createDataFrame(records, schema), res, reg, T0 + timedelta(hours=hours), 48, path)
        got = sorted((r["run_id"] or "", r["duration_minutes"], r["rows_processed"], r["team"], r["normal_rows"]) for r in out.collect())
        assert got == [("", 3.0 if hours == 5 or done else 1.0, 7, "t", 7), ("x", 2.0, 7, "t", 7), ("y", 1.0, 11, "t", 7)]
        done = hours == 5
