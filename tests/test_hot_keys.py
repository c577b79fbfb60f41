"""Chunked (hot-key-safe) forms equal the plain per-key windows on a skewed fixture."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from runsight.operators import metrics as M
from runsight.operators import sla as H
from runsight.operators import velocity as VL
from runsight.operators.chunked import positions

SCHEMA = ("job_name string, team string, impact string, sla_minutes double, run_id string, start_time timestamp, "
          "duration_minutes double, rows_processed long, status string")


def skewed_runs(spark):
    rnd = random.Random(11)
    t0 = datetime(2026, 1, 1)
    rows = []
    for i in range(3000):  # one job with most of the runs, ties on start_time and at midnight
        t = t0 + timedelta(hours=rnd.randint(0, 24 * 40)) if i % 7 else t0 + timedelta(days=rnd.randint(0, 40))
        rows.append(("hot", "t", "high", 60.0, f"r{i:05d}", t, float(rnd.randint(1, 50)), rnd.randint(0, 10**6),
                     "success"))
    for j in range(5):
        for i in range(40):
            rows.append((f"cold{j}", "t", "low", 60.0, f"c{i:03d}", t0 + timedelta(hours=7 * i),
                         float(rnd.randint(1, 50)), rnd.randint(0, 1000), "success"))
    return spark.createDataFrame(rows, SCHEMA)


def test_hot_key_gets_many_chunks(spark):
    from runsight.operators.chunked import with_chunks
    c, split = with_chunks(skewed_runs(spark), "job_name", ["start_time", "run_id"], target_rows=50)
    assert split and not with_chunks(skewed_runs(spark), "job_name", ["start_time"], target_rows=5000)[1]
    per = {r["job_name"]: r["n"] for r in c.groupBy("job_name").agg(F.count_distinct("_c").alias("n")).collect()}
    assert per["hot"] >= 30 and per["cold0"] < per["hot"]


def test_positions_equal_row_number(spark):
    from pyspark.sql import Window
    r = skewed_runs(spark)
    w = Window.partitionBy("job_name").orderBy("start_time", "run_id")
    want = {(x["job_name"], x["run_id"]): (x["pos"], x["n"]) for x in
            r.select("job_name", "run_id", F.row_number().over(w).alias("pos"),
                     F.count(F.lit(1)).over(Window.partitionBy("job_name")).alias("n")).collect()}
    got = {(x["job_name"], x["run_id"]): (x["pos"], x["n"]) for x in
           positions(r, "job_name", ["start_time", "run_id"], target_rows=50).collect()}
    assert got == want


def test_volume_growth_split_equals_plain(spark):
    r = skewed_runs(spark)
    a = sorted(map(tuple, H.volume_growth(r, chunk_rows=50).collect()))
    b = sorted(map(tuple, H.volume_growth(r, split_hot=False).collect()))
    assert a == b


def test_replay_split_equals_plain(spark):
    r = skewed_runs(spark)
    a = {(x["job_name"], x["run_id"]): x for x in M.replay_scores(r, chunk_rows=50).collect()}
    b = {(x["job_name"], x["run_id"]): x for x in M.replay_scores(r, split_hot=False).collect()}
    assert a.keys() == b.keys()
    diff = [k for k in a if a[k]["prior_runs"] != b[k]["prior_runs"]
            or a[k]["time_drift_score"] != b[k]["time_drift_score"]
            or a[k]["volume_drift_score"] != b[k]["volume_drift_score"]]
    assert diff == []


def test_trailing_split_equals_plain(spark):
    rnd = random.Random(5)
    t0 = datetime(2026, 1, 1)
    tx = [(0 if i % 3 else rnd.randint(1, 4), i, 1.0, t0 + timedelta(seconds=rnd.randint(0, 3 * 3600)))
          for i in range(2000)]
    tx += [(0, 5000, 1.0, t0 + timedelta(minutes=5)), (0, 5001, 1.0, t0 + timedelta(minutes=10))]  # on edges
    df = spark.createDataFrame(tx, "account_id long, txn_id long, amount double, ts timestamp")
    for minutes, thr in ((5, 3), (60, 10)):
        a = sorted(map(tuple, VL.velocity_trailing(df, minutes, thr, chunk_rows=40).collect()))
        b = sorted(map(tuple, VL.velocity_trailing(df, minutes, thr, split_hot=False).collect()))
        assert a == b and len(a) > 0


def test_exact_quantile_large_keys_and_ties(spark):
    from runsight.operators.quantiles import exact_quantile
    rnd = random.Random(9)
    rows = [("hot", float(rnd.randint(0, 10**6))) for _ in range(20000)]
    rows += [("ties", float(rnd.choice([1, 2, 2, 3, 3, 3]))) for _ in range(8000)]
    rows += [("small", float(x)) for x in range(7)] + [("one", 5.0), ("nulls", None), ("nulls", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    for q in (0.95, 0.5, 0.0, 1.0):
        got = {r["k"]: r["p"] for r in exact_quantile(df, "k", "v", q, accuracy=100, alias="p").collect()}
        want = {r["k"]: r["p"] for r in df.groupBy("k").agg(F.percentile("v", q).alias("p")).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert abs(got[k] - want[k]) <= 1e-9 * max(1.0, abs(want[k])), (q, k, got[k], want[k])


def test_undated_runs_stay(spark):
    r = skewed_runs(spark).withColumn("start_time", F.when(~F.col("run_id").endswith("7"), F.col("start_time")))
    for rows in (30, 2_000_000):
        a = sorted(map(str, M.replay_scores(r, chunk_rows=rows).collect()))
        assert len(a) == r.count() and a == sorted(map(str, M.replay_scores(r, split_hot=False).collect()))
        g = sorted(map(tuple, H.volume_growth(r, chunk_rows=rows).collect()))
        assert g == sorted(map(tuple, H.volume_growth(r, split_hot=False).collect()))


def test_repeated_ids_stay_rows(spark):
    t0 = datetime(2026, 1, 1)
    rows = [("a", i % 3, t0 + timedelta(minutes=i % 5)) for i in range(20)] + [("a", 1, None), ("a", 2, None), (None, 7, t0)]
    tx = spark.createDataFrame(rows, "account_id string, txn_id long, ts timestamp")
    for n in (4, 2_000_000):
        got = sorted(map(str, VL.velocity_trailing(tx, 2, 0, chunk_rows=n).collect()))
        assert got == sorted(map(str, VL.velocity_trailing(tx, 2, 0, split_hot=False).collect()))


def test_burst_in_a_long_history_is_split(spark):
    from runsight.operators.chunked import with_chunks
    burst = spark.range(200_000).select(F.lit("hot").alias("job_name"), F.timestamp_micros(
        F.lit(1_700_000_000_000_000) + F.col("id") * 1_000_000).alias("start_time"))
    cold = spark.range(400).select(F.lit("cold").alias("job_name"), F.timestamp_micros(
        F.lit(1_380_000_000_000_000) + F.col("id") * 800_000_000_000).alias("start_time"))
    rows = with_chunks(burst.unionByName(cold), "job_name", ["start_time"], target_rows=2000)[0]
    assert rows.groupBy("job_name", "_c").count().agg(F.max("count")).first()[0] <= 4000


def test_one_instant_is_split(spark):
    """400,000 rows of one key, half of them at one instant: no chunk above twice the target, the order is whole."""
    from runsight.operators.chunked import with_chunks
    at = F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id"))
    rows = spark.range(400_000).select(F.lit("hot").alias("k"), F.timestamp_micros(at).alias("t"), F.col("id").alias("tie"))
    got = with_chunks(rows, "k", ["t", "tie"], target_rows=1000)[0].groupBy("_c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "tie")).alias("lo"), F.max(F.struct("t", "tie")).alias("hi"))
    chunks = got.orderBy("_c").collect()
    assert sum(c.n for c in chunks) == 400_000 and max(c.n for c in chunks) <= 2000 and len(chunks) > 300
    assert all(a.hi < b.lo for a, b in zip(chunks, chunks[1:], strict=False))


def test_nearest_on_both_sides_against_brute_force(spark):
    from runsight.operators.asof import asof_join
    rnd = random.Random(12)
    t0 = datetime(2026, 1, 1)
    left = [(i, rnd.choice("ab"), t0 + timedelta(minutes=rnd.choice([30, rnd.randint(0, 600)]))) for i in range(500)]
    right = [(rnd.choice("ab"), t0 + timedelta(minutes=rnd.choice([30, rnd.randint(60, 500)])), i) for i in range(60)]
    L = spark.createDataFrame(left, "id long, k string, at timestamp")
    R = spark.createDataFrame(right, "k string, seen timestamp, v long")
    for by in ("k", None):
        for direction in ("before", "after", "nearest"):
            want = {}
            for i, k, at in left:
                fits = [(abs(s - at), s, -v) for rk, s, v in right if (by is None or rk == k) and (
                    direction == "nearest" or (s <= at if direction == "before" else s >= at))]
                want[i] = -min(fits)[2] if fits else None
            for n in (20, 2_000_000):
                got = asof_join(L, R, by, "at", "seen", ["v"], direction, target_rows=n).collect()
                assert {r["id"]: r["v"] for r in got} == want


def test_asof_keeps_left_rows_without_key_or_time(spark):
    from runsight.operators.asof import asof_join
    t0 = datetime(2026, 1, 1)
    left = spark.createDataFrame([("a", t0 + timedelta(hours=2)), (None, t0), ("a", None)], "k string, at timestamp")
    right = spark.createDataFrame([("a", t0, 1), (None, t0, 9), ("a", None, 8)], "k string, seen timestamp, v int")
    for n in (1, 2_000_000):
        got = asof_join(left, right, "k", "at", "seen", ["v"], target_rows=n).collect()
        assert sorted((str(r["k"]), str(r["at"]), r["v"]) for r in got) == sorted(
            [("a", str(t0 + timedelta(hours=2)), 1), ("None", str(t0), None), ("a", "None", None)])


def test_rank_of_a_long_table_equals_the_plain_window(spark):
    from pyspark.sql import Window

    from runsight.operators.summaries import share_ranked
    rows = spark.range(3000).select("id", F.when(F.col("id") % 50 != 0, F.col("id") * 7919 % 400).alias("v"))
    want = sorted(map(str, rows.withColumn("rank", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last()))).collect()))
    for n in (100, 2_000_000):
        assert sorted(map(str, share_ranked(rows, "v", n).select("id", "v", "rank").collect())) == want
