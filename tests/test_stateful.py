"""Streams with the state API against batch results, eviction of their state, and types of raw records."""

import tempfile
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from runsight.operators import quality as Q
from runsight.operators import velocity as V
from runsight.streaming import runs as ST


def test_moments_before_many_batches():
    rng = np.random.default_rng(3)
    x = np.where(rng.random(500) < 0.1, np.nan, 1e9 + rng.normal(size=500))
    n, mean, m2 = 0, 0.0, 0.0
    got = []
    for part in np.array_split(x, 17):
        c, m, q = ST.moments_before(part, n, mean, m2)
        got += zip(c[:-1], m[:-1], q[:-1], strict=True)
        n, mean, m2 = int(c[-1]), float(m[-1]), float(q[-1])
    for i, (c, m, q) in enumerate(got):
        seen = x[:i][~np.isnan(x[:i])]
        assert c == len(seen)
        if c > 1:
            assert m == pytest.approx(seen.mean(), rel=1e-12)
            assert q == pytest.approx(((seen - seen.mean()) ** 2).sum(), rel=1e-4)
    assert ST.moments_before(np.array([2.0, 2.0]), 3, 2.0, 0.0)[2].tolist() == [0.0, 0.0, 0.0]


def test_trailing_stream_equals_batch_and_forgets(spark):
    base = spark.range(600).select(
        (F.col("id") % 3).alias("account_id"), F.floor(F.col("id") / 2).alias("txn_id"),
        F.timestamp_seconds(1_000_000 + F.col("id") * 20 - F.col("id") % 5 * 20).alias("ts"))
    base = base.unionByName(spark.sql("SELECT 0L AS account_id, 999L AS txn_id, CAST(NULL AS TIMESTAMP) AS ts"))
    far = spark.sql("SELECT 7L AS account_id, 1L AS txn_id, timestamp_seconds(1200000) AS ts")
    farther = spark.sql("SELECT 7L AS account_id, 2L AS txn_id, timestamp_seconds(1400000) AS ts")
    src, _ = ST.scratch(spark, "trail-src")
    out, ck = ST.scratch(spark, "trail")
    kept = []
    parts = [base.filter("ts < timestamp_seconds(1005000)"), base.filter("ts >= timestamp_seconds(1005000) OR ts IS NULL"), far, farther]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(src)
        s = ST.trailing_counts(ST.read_stream(spark, src, base.schema), 5)
        q = ST.run_stateful(spark, s.writeStream.format("parquet").option("path", out), ck)
        kept.append([p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators][-1])
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    want = V.velocity_trailing(base.filter("ts IS NOT NULL").unionByName(far), 5, 0)
    assert got == sorted(map(tuple, want.select("account_id", "txn_id", "ts", "trailing_count").collect()))
    assert kept[-1] < kept[0] and kept[-1] <= 4  # only the newest account is left


def test_type_report(spark):
    lines = ['{"job_name": "a", "rows_processed": 1, "sla_minutes": 5}', '{"job_name": 7, "sla_minutes": 1.5}', "{}", '{"job_name"',
             "[1]", "", None, '{"job_name": null, "extra": [true]}']
    df = Q.as_variant(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = {(r.field, r.found_type): (r.expected_type, r.records, r.share_pct, r.drift) for r in Q.type_report(df).collect()}
    assert got == {("job_name", "string"): ("string", 1, 12.5, False), ("job_name", "integer"): ("string", 1, 12.5, True),
                   ("job_name", "null"): ("string", 1, 12.5, False), ("rows_processed", "integer"): ("integer", 1, 12.5, False),
                   ("sla_minutes", "integer"): ("number", 1, 12.5, False), ("sla_minutes", "number"): ("number", 1, 12.5, False),
                   ("extra", "array"): (None, 1, 12.5, True), (None, "unreadable"): (None, 4, 50.0, True)}
    assert Q.type_report(df.limit(0)).collect() == []
    assert "extra: ARRAY<BOOLEAN>" in Q.merged_schema(df).first()[0]


def test_landed_files_have_bounded_rows(spark):
    """More rows than the files may hold give more files, still cut by range; a task writes no more than one."""
    d = tempfile.mkdtemp(prefix="runsight-land-")
    df = spark.range(10_000).withColumn("at", F.hash("id"))
    ST.land(df, f"{d}/many", 4, "at", most_rows=500)
    ST.land(df, f"{d}/few", 4, "at")
    per = {n: spark.read.parquet(f"{d}/{n}").groupBy(F.input_file_name()).agg(F.count(F.lit(1)), F.min("at"), F.max("at")).collect()
           for n in ("many", "few")}
    assert len(per["few"]) == 4 and len(per["many"]) == 20 and max(r[1] for r in per["many"]) < 1000
    spans = sorted((r[2], r[3]) for r in per["many"])
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert spark.read.parquet(f"{d}/many").distinct().count() == 10_000


def test_silver_of_copies_and_corrections(spark):
    """Copies in a batch, equal and corrected copies later, NULLs in the key: silver holds each different copy once, and
    reading the current ones takes only the columns asked for."""
    schema = "job_name string, team string, run_id string, start_time timestamp, duration_minutes double, rows_processed long, status string"
    at = [datetime(2026, 1, 5, 10), datetime(2026, 2, 5, 10), None]

    def rows(*r):
        return spark.createDataFrame([(j, "t", i, at[k], d, n, s) for j, i, k, d, n, s in r], schema)

    src, _ = ST.scratch(spark, "corr-src")
    out, ck = ST.scratch(spark, "corr")
    first = rows(("a", "1", 0, 4.0, 1, "failed"), ("a", "1", 0, 9.0, 1, "success"), ("a", None, 0, 1.0, 1, "success"),
                 (None, "a", 1, 2.0, 1, "success"), ("b", "2", 2, None, None, None), ("c", "3", 1, 3.0, 1, "failed"))
    again = rows(("a", "1", 0, 9.0, 1, "success"), ("c", "3", 1, 3.0, 1, "success"), ("b", "2", 2, None, None, None),
                 (None, "a", 0, 2.0, 1, "success"), ("d", "4", 1, 1.0, 2, "success"), ("d", "4", 1, 1.0, 3, "success"))
    back = rows(("c", "3", 1, 3.0, 1, "failed"), ("a", None, 0, 1.0, 1, "success"))
    for part in (first, again, back):
        part.coalesce(1).write.mode("append").parquet(src)
        ST.append_new_runs(spark, ST.read_stream(spark, src, first.schema), out, ck)
    silver = spark.read.parquet(out)
    assert {r["batch_id"]: r["count"] for r in silver.groupBy("batch_id").count().collect()} == {0: 5, 1: 3, 2: 1}
    got = {(r["job_name"], r["run_id"], r["start_time"], r["duration_minutes"], r["rows_processed"], r["status"])
           for r in ST.current_runs(spark, out).collect()}
    assert got == {("a", "1", at[0], 9.0, 1, "success"), ("a", None, at[0], 1.0, 1, "success"), (None, "a", at[1], 2.0, 1, "success"),
                   ("b", "2", None, None, None, None), ("c", "3", at[1], 3.0, 1, "failed"), (None, "a", at[0], 2.0, 1, "success"),
                   ("d", "4", at[1], 1.0, 3, "success")}
    plan = ST.current_runs(spark, out).groupBy("job_name").count()._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan and "rows_processed" not in plan  # columns that are not asked for are not shuffled


def test_trailing_state_is_one_value_an_account(spark):
    """A state row an account, however many transactions it holds."""
    df = spark.range(300).select((F.col("id") % 3).alias("account_id"), F.col("id").alias("txn_id"),
                                 F.timestamp_seconds(1_000_000 + F.col("id")).alias("ts"))
    src, _ = ST.scratch(spark, "one-src")
    out, ck = ST.scratch(spark, "one")
    df.coalesce(1).write.parquet(src)
    s = ST.trailing_counts(ST.read_stream(spark, src, df.schema), 5)
    q = ST.run_stateful(spark, s.writeStream.format("parquet").option("path", out), ck)
    rows = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(rows) <= 3 * 3  # the value and its timer, under two keys
