"""Incremental baselines and bucketed publication."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from runsight.operators import baselines as B
from runsight.operators import incidents as K
from runsight.operators import metrics as M
from runsight.session import scratch_dir
from runsight.sources import files as IO

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("job_name string, team string, impact string, sla_minutes double, run_id string, start_time timestamp, "
          "duration_minutes double, rows_processed long, status string")


def runs(spark, spec):
    return spark.createDataFrame(
        [(j, "t", "high", 50.0, f"r{i:05d}", None if i is None else T0 + dt.timedelta(minutes=i), d, r, s)
         for j, i, d, r, s in spec], SCHEMA)


def test_refreshes_equal_the_whole(spark):
    spec = [("a", i, 1e6 + (i % 7) * 1e-2, 10 * i, "failed" if i % 5 == 0 else "success") for i in range(400)]
    spec += [("b", i, None, None, "success") for i in range(40)] + [("c", 3, 5.0, 7, "success")]
    spec += [("d", i, 2.0, 3, "success") for i in range(35)] + [(None, 1, 1.0, 1, "success")]
    state, gold = scratch_dir(spark, "s"), scratch_dir(spark, "g")
    for n in range(4):
        B.refresh(runs(spark, spec[n::4]), state, gold, n, buckets=4)
    B.refresh(runs(spark, spec[3::4]), state, gold, 3, buckets=4)  # replayed
    B.refresh(runs(spark, []), state, gold, 4, buckets=4)
    whole = {r.job_name: r.asDict() for r in M.job_metrics(runs(spark, spec)).collect()}
    got = {r.job_name: r.asDict() for r in B.gold(spark, gold).collect()}
    assert got.keys() == whole.keys()
    for job, row in whole.items():
        for c, v in row.items():
            if c == "p95_duration":
                assert (got[job][c] is None) == (v is None)
            elif isinstance(v, float):
                assert got[job][c] == pytest.approx(v, abs=2e-3), (job, c)
            else:
                assert got[job][c] == v, (job, c)


def test_sketch_rank_over_many_merges(spark):
    r = spark.range(200_000).select(F.lit("a").alias("job_name"), F.lit("t").alias("team"), F.lit("low").alias("impact"),
                                    F.lit(1.0).alias("sla_minutes"), F.col("id").cast("string").alias("run_id"),
                                    F.timestamp_seconds("id").alias("start_time"),
                                    F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("duration_minutes"),
                                    F.col("id").alias("rows_processed"), F.lit("success").alias("status"), "id")
    parts = None
    for n in range(20):
        one = B.partials(r.filter(F.col("id") % 20 == n))
        parts = one if parts is None else parts.unionByName(one)
    p = B.metrics_of(B.fold(parts)).first().p95_duration
    rank = r.filter(F.col("duration_minutes") <= p).count() / 200_000
    assert abs(rank - 0.95) <= B.RANK_ERROR


def test_publication_touches_only_its_buckets(spark):
    path = scratch_dir(spark, "buckets")
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    assert IO.publish_buckets(df, path, "k", 8, 0) == list(range(8))
    before = IO.manifest(spark, path)["versions"]
    one = df.filter(IO.bucket_of("k", 8) == 5).withColumn("v", F.lit(2))
    assert IO.publish_buckets(one, path, "k", 8, 1) == [5]
    after = IO.manifest(spark, path)["versions"]
    assert {b for b in after if after[b] != before[b]} == {"5"}
    now = IO.read_buckets(spark, path)
    assert now.count() == 1000 and now.filter("v = 2").count() == one.count()
    assert IO.read_buckets(spark, path, only=[5]).filter("v = 1").count() == 0
    with pytest.raises(ValueError):
        IO.publish_buckets(df, path, "k", 9, 2)
    IO.publish_buckets(df, path, "k", 8, 2, keep_hours=0.0)
    assert len(glob.glob(f"{path}/v-*")) == 1


def test_resolutions_are_stored_once(spark):
    path = scratch_dir(spark, "inc")
    at = T0 + dt.timedelta(hours=1)
    inc = spark.createDataFrame([(j, T0, None) for j in "abc"], "job_name string, detected_at timestamp, resolved_at timestamp")
    IO.publish_buckets(inc, path, "job_name", 4, 0)

    def res(*rows):
        return spark.createDataFrame(list(rows), inc.schema)
    K.publish_resolutions(spark, path, res(("a", T0, at), ("a", T0, at + dt.timedelta(hours=1)), ("z", T0, at)), 1)
    K.publish_resolutions(spark, path, res(("b", T0, at)), 1)  # number 1 is done: nothing
    K.publish_resolutions(spark, path, res(("a", T0, at + dt.timedelta(hours=2)), ("c", T0, at)), 2)
    got = {r.job_name: r.resolved_at for r in IO.read_buckets(spark, path).collect()}
    assert got == {"a": at, "b": None, "c": at}


def test_sql_functions_follow_publications(spark):
    from runsight.plans import sqlaccess as SA
    path = scratch_dir(spark, "gold")
    for minutes, verdict in ((60.0, "breached"), (10.0, "safe")):
        r = runs(spark, [("a", i, minutes if i == 39 else 10.0 + i % 3, 5, "success") for i in range(40)])
        IO.replace_atomic(M.job_metrics(r, as_of=T0), path)
        SA.publish(spark, {"gold_job_metrics": path}, "sqltest")
        got = spark.sql("SELECT * FROM drilldown(:job)", args={"job": "a"}).collect()
        assert [(x.latest_duration, x.verdict) for x in got] == [(minutes, verdict)]
        assert spark.sql("SELECT * FROM drilldown('b')").count() == 0
        assert spark.sql("SELECT * FROM urgent_jobs()").count() == (verdict == "breached")
        assert spark.sql("SELECT * FROM team_jobs('t', 5.0)").count() == (verdict == "breached")
    plan = spark.sql("SELECT * FROM drilldown('a')")._jdf.queryExecution().toString()
    assert "EqualTo(job_name,a)" in plan


def test_managed_form_splits_and_stamps(spark):
    r = runs(spark, [("a", i, 10.0 + i, 5, "success") for i in range(4)]).withColumns(
        {"cycle_number": F.minute("start_time").cast("long"), "normal_rows": F.when(F.col("run_id") < "r00002", 1).otherwise(2)})
    got = sorted((x.normal_rows, x.total_runs, x.latest_cycle, x.verdict, x.verdict_computed_at)
                 for x in M.managed_metrics(r, T0).collect())
    assert got == [(1, 2, 1, "safe", T0), (2, 2, 3, "safe", T0)]
