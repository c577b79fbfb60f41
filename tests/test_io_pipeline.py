"""Sources/sinks and the end-to-end pipeline."""

import gzip
import json
import os
import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from runsight.plans import pipeline
from runsight.sources import files as IO
from runsight.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_json_array_reader_quarantines_bad_records(spark):
    d = tempfile.mkdtemp(prefix="runsight-json-")
    good = [{"job_name": "a", "start_time": "2026-05-31T11:41:52.000001", "duration_minutes": 3.5,
             "rows_processed": 10, "status": "success", "depends_on": ["b"]},
            {"job_name": "b", "start_time": "2026-05-31T11:42:00", "duration_minutes": 1.0,
             "rows_processed": 5, "status": "failed", "depends_on": []}]
    with open(os.path.join(d, "cycle_1.json"), "w") as f:
        json.dump(good, f, indent=2)
    with open(os.path.join(d, "cycle_2.json"), "w") as f:
        f.write('[{"job_name": "c", "duration_minutes": "slow"}]')
    df = IO.read_runs_json(spark, d)
    rows = {r["job_name"]: r for r in df.collect() if r["job_name"]}
    assert rows["a"]["duration_minutes"] == 3.5 and rows["a"]["depends_on"] == ["b"]
    assert rows["b"]["status"] == "failed"
    clean = IO.clean_runs(df, "2026-06-01 00:00:00")
    assert clean.filter(F.col("quarantined")).count() >= 1


def test_atomic_replace_keeps_old_version_readable(spark):
    d = tempfile.mkdtemp(prefix="runsight-gold-")
    v1 = IO.replace_atomic(spark.range(3), d)
    old = spark.read.parquet(f"{d}/{v1}")
    IO.replace_atomic(spark.range(5), d)
    assert IO.read_current(spark, d).count() == 5 and old.count() == 3


def test_old_versions_are_removed(spark):
    d = tempfile.mkdtemp(prefix="runsight-gold-")
    for n in range(4):
        IO.replace_atomic(spark.range(n), d)
    assert len([f for f in os.listdir(d) if f.startswith("v-")]) == 4  # younger than a day
    last = IO.replace_atomic(spark.range(9), d, keep_hours=0)
    assert [f for f in os.listdir(d) if f.startswith("v-")] == [last] and IO.read_current(spark, d).count() == 9


def test_newest_copy_of_a_run_wins(spark):
    """Copies in one batch, a corrected run, an older replay; other days' files stay as they are."""
    d = os.path.join(tempfile.mkdtemp(prefix="runsight-silver-"), "runs")
    schema = "job string, at timestamp, minutes double, status string, landed timestamp"
    key = ["job", "at"]

    def rows(*r, landed):
        return spark.createDataFrame([(j, datetime.fromisoformat(t), m, s, datetime.fromisoformat(landed)) for j, t, m, s in r], schema)

    first = rows(("a", "2026-01-05 10:00", 10.0, "success"), ("a", "2026-01-05 10:00", 4.0, "failed"),
                 ("b", "2026-01-06 10:00", 5.0, "success"), ("c", "2026-03-01 10:00", 1.0, "success"), landed="2026-03-02")
    first = IO.newest(first, key, ["minutes", "status"])
    IO.upsert_partitioned(first, d, key, "at", "landed")
    files = {f for _, _, names in os.walk(os.path.join(d, "year=2026", "month=3")) for f in names}
    again = rows(("a", "2026-01-05 10:00", 15.0, "failed"), ("b", "2026-01-06 10:00", 5.0, "success"),
                 ("e", "2026-01-05 11:00", 2.0, "success"), landed="2026-03-03")
    IO.upsert_partitioned(again, d, key, "at", "landed")
    for replay in (first, again, first):
        IO.upsert_partitioned(replay, d, key, "at", "landed")
        got = {(r["job"], r["minutes"], r["status"]) for r in spark.read.parquet(d).collect()}
        assert got == {("a", 15.0, "failed"), ("b", 5.0, "success"), ("c", 1.0, "success"), ("e", 2.0, "success")}
        assert spark.read.parquet(d).count() == 4
    assert files == {f for _, _, names in os.walk(os.path.join(d, "year=2026", "month=3")) for f in names}


def test_pipeline_writes_five_gold_tables(spark):
    t = fx.Tables(spark, SF)
    out = tempfile.mkdtemp(prefix="runsight-pipeline-")
    gold = pipeline.run(fx.runs(t), fx.registry(t), fx.infra_metrics(t), fx.ci_runs(t), fx.deadlines(t),
                        fx.DEADLINE_AS_OF, out)
    assert set(gold) == {"gold_job_metrics", "gold_verdicts", "gold_fingerprint", "gold_sla_health",
                         "gold_deadline_risk"}
    counts = {r["verdict"]: r["jobs"] for r in pipeline.summary(gold).collect()}
    assert counts == {"safe": 6, "at_risk": 1, "breached": 3, "insufficient_data": 0}
    assert gold["gold_verdicts"].count() == 4 and gold["gold_deadline_risk"].count() == 5  # five deadlines, one without jobs
    assert all(os.path.isdir(os.path.join(out, n)) for n in gold)


def test_json_arrays_without_a_shuffle(spark):
    """Each file one array of at most so many records; nothing is shuffled and the files are compressed."""
    d = tempfile.mkdtemp(prefix="runsight-json-")
    df = spark.range(0, 95, 1, 3).select(F.concat(F.lit("job\n"), "id").alias("job_name"), F.col("id").alias("rows_processed"))
    IO.write_json_arrays(df, f"{d}/a", rows_per_file=10)
    files = [os.path.join(d, "a", f) for f in os.listdir(f"{d}/a") if f.startswith("part-")]
    sizes = [len(json.loads(gzip.open(f, "rt").read())) for f in files]
    assert sum(sizes) == 95 and max(sizes) == 10 and len(sizes) == 12  # 31, 32 and 32 rows
    back = IO.read_runs_json(spark, f"{d}/a")
    assert sorted(map(tuple, back.select("job_name", "rows_processed").collect())) == sorted(map(tuple, df.collect()))
    IO.write_json_arrays(df.limit(0), f"{d}/none")
    assert IO.read_runs_json(spark, f"{d}/none").count() == 0


def test_runs_are_not_shuffled_to_a_small_registry(spark):
    plan = fx.runs(fx.Tables(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
