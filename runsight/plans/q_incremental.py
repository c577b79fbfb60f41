"""Incremental baselines, publication by key bucket, the managed job's form, SQL functions, and readers of the other inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import lit_ts, rnd
from runsight.operators import baselines as B
from runsight.operators import deadlines as D
from runsight.operators import graph as G
from runsight.operators import incidents as K
from runsight.operators import metrics as M
from runsight.plans import oracle as O
from runsight.plans import sqlaccess as SA
from runsight.plans.catalog import register
from runsight.plans.q_core import METRIC_COLS
from runsight.plans.q_ops import INC, TSF
from runsight.plans.q_stream import RUN_CUTS, RUN_STREAM_COLS
from runsight.session import scratch_dir
from runsight.sources import files as IO
from runsight.sources import fixtures as fx
from runsight.sources import schemas as SC
from runsight.sources import signals as S
from runsight.streaming import runs as ST

STATED = [c for c in METRIC_COLS if c != "p95_duration"]
INCREMENTAL_SQL = (O.BASE + f"SELECT {O.METRICS_COLS.replace('p95_duration, ', '')}, "
                   "CASE WHEN total_runs >= 30 THEN TRUE END AS p95_in_rank FROM m")


def with_rank_check(gold: DataFrame, runs: DataFrame) -> DataFrame:
    """``gold`` without its p95, which is held against the runs: TRUE where its rank is within the stated error of 0.95."""
    d = F.col("duration_minutes")
    p = F.col("p95_duration")
    share = (runs.join(gold.select("job_name", "p95_duration"), "job_name").filter(p.isNotNull()).groupBy("job_name")
             .agg((F.count_if(d < p) / F.count(d)).alias("_lo"), (F.count_if(d <= p) / F.count(d)).alias("_hi")))
    good = (F.col("_lo") <= 0.95 + B.RANK_ERROR) & (F.col("_hi") >= 0.95 - B.RANK_ERROR)
    return gold.join(share, "job_name", "left").select(*STATED, good.alias("p95_in_rank"))


@register("job_metrics_incremental", INCREMENTAL_SQL)
def q_job_metrics_incremental(t):
    """Four refreshes, each reading its own runs only (the last one twice), equal the baselines of all runs."""
    r = fx.runs(t).select(*RUN_STREAM_COLS)
    state, gold = scratch_dir(t.spark, "baseline-state"), scratch_dir(t.spark, "baseline-gold")
    for number, (lo, hi) in enumerate(zip([None, *RUN_CUTS], [*RUN_CUTS, None], strict=True)):
        part = r if lo is None else r.filter(F.col("start_time") >= lit_ts(lo))
        part = part if hi is None else part.filter(F.col("start_time") < lit_ts(hi))
        B.refresh(part, state, gold, number)
    B.refresh(part, state, gold, number)
    return with_rank_check(B.gold(t.spark, gold), r)


@register("stream_gold_incremental", INCREMENTAL_SQL)
def q_stream_gold_incremental(t):
    """A stream of four landings refreshes gold; a batch rewrites only the buckets of its jobs."""
    r = fx.runs(t).select(*RUN_STREAM_COLS)
    src, ck = ST.scratch(t.spark, "incremental-src")
    state, gold = scratch_dir(t.spark, "baseline-state"), scratch_dir(t.spark, "baseline-gold")
    ST.in_steps(r, src, "start_time", RUN_CUTS,
                lambda: B.stream_refresh(ST.read_stream(t.spark, src, r.schema), state, gold, ck))
    return with_rank_check(B.gold(t.spark, gold), r)


@register("incident_resolved_stored", INC + f"""SELECT job_name, team, verdict, strftime(detected_at, {TSF}) AS detected_at,
  strftime(resolved_at, {TSF}) AS resolved_at FROM inc""")
def q_incident_resolved_stored(t):
    """K3: the stored incidents take resolutions in two publications; the second brings later ones of the same incidents too."""
    urgent = M.job_metrics(fx.runs(t), p95="none").filter(F.col("verdict").isin("breached", "at_risk"))
    inc = fx.incidents(t, urgent).select("job_name", "team", "verdict", "detected_at", "resolved_at")
    path = scratch_dir(t.spark, "incidents")
    IO.publish_buckets(inc.withColumn("resolved_at", F.lit(None).cast("timestamp")), path, "job_name", 64, 0)
    first = inc.filter(F.col("resolved_at").isNotNull()).select("job_name", "detected_at", "resolved_at")
    half = F.pmod(F.xxhash64("job_name"), F.lit(2)) == 0
    later = first.withColumn("resolved_at", F.col("resolved_at") + F.expr("INTERVAL 4 MINUTES"))
    K.publish_resolutions(t.spark, path, first.filter(half), 1)
    K.publish_resolutions(t.spark, path, later.filter(half).unionByName(first.filter(~half)), 2)
    K.publish_resolutions(t.spark, path, later, 2)
    return IO.read_buckets(t.spark, path)


@register("managed_metrics", O.with_(O.SUP, O.RUNS) + f""", g AS (SELECT * REPLACE (CASE WHEN line_no <= 3 THEN sla_minutes
    ELSE sla_minutes + 4 END AS sla_minutes), CAST(line_no AS BIGINT) AS cycle_number FROM runs),
a AS (SELECT job_name, team, impact, sla_minutes, normal_rows, count(duration_minutes) AS duration_runs,
    avg(duration_minutes) AS a_d, stddev_samp(duration_minutes) AS s_d, avg(rows_processed) AS a_r, stddev_samp(rows_processed) AS s_r,
    avg(CASE WHEN status = 'failed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS f,
    arg_max(duration_minutes, (start_time, run_id)) AS l_d, arg_max(rows_processed, (start_time, run_id)) AS l_r,
    arg_max(status, (start_time, run_id)) AS latest_status, max(start_time) AS latest_start_time,
    arg_max(cycle_number, (start_time, run_id)) AS latest_cycle
  FROM g GROUP BY ALL),
z AS (SELECT *, CASE WHEN s_d > 0 THEN (l_d - a_d) / s_d ELSE 0.0 END AS td,
    CASE WHEN s_r > 0 THEN (l_r - a_r) / s_r ELSE 0.0 END AS vd FROM a)
SELECT job_name, team, impact, sla_minutes, normal_rows, duration_runs, latest_status, latest_cycle,
  strftime(latest_start_time, {TSF}) AS latest_start_time, {O.R('a_d', 6)} AS avg_duration, {O.R('a_r', 3)} AS avg_rows,
  {O.R('f', 6)} AS failure_rate, {O.R('td', 6)} AS time_drift_score, {O.R('vd', 6)} AS volume_drift_score,
  CASE WHEN l_d > sla_minutes THEN 'breached' WHEN td > 1.5 OR vd < -1.5 THEN 'at_risk' ELSE 'safe' END AS verdict,
  '2001-11-05 00:00:00.000000' AS verdict_computed_at FROM z""")
def q_managed_metrics(t):
    """A1/A1g/P2 in the managed job's form: an SLA change splits a job; no gate, raw comparison, latest cycle, stamp."""
    changed = F.when(F.col("line_no") <= 3, F.col("sla_minutes")).otherwise(F.col("sla_minutes") + 4)
    r = fx.runs(t).withColumns({"sla_minutes": changed, "cycle_number": F.col("line_no").cast("long")})
    m = M.managed_metrics(r, fx.INCIDENT_AS_OF)
    places = {"avg_duration": 6, "avg_rows": 3, "failure_rate": 6, "time_drift_score": 6, "volume_drift_score": 6}
    return m.withColumns({c: rnd(c, n) for c, n in places.items()}).select(
        "job_name", "team", "impact", "sla_minutes", "normal_rows", "duration_runs", "latest_status", "latest_cycle",
        "latest_start_time", *places, "verdict", "verdict_computed_at")


@register("view_drilldown", O.BASE + """SELECT job_name, latest_duration, sla_minutes, verdict, priority_score FROM m
  WHERE verdict IN ('breached', 'at_risk')""")
def q_view_drilldown(t):
    """The drill-down page by SQL: a table function with a parameter, called for each urgent job of the catalog table."""
    path = scratch_dir(t.spark, "gold")
    IO.replace_atomic(M.job_metrics(fx.runs(t), p95="none"), path)
    SA.publish(t.spark, {"gold_job_metrics": path})
    return t.spark.sql("SELECT d.* FROM urgent_jobs() u, LATERAL drilldown(u.job_name) d")


@register("deadline_critical_jobs", O.with_(O.SUP, O.RUNS, O.metrics_cte()) + """
SELECT ['ledger_lock', 'branch_close', 'fee_posting', 'night_seal'][k % 20 + 1] AS deadline_name, CAST(k // 20 AS INTEGER) AS pos,
  job_name, verdict FROM sup JOIN m USING (job_name) WHERE k % 20 < 4 AND verdict IN ('at_risk', 'breached')""")
def q_deadline_critical_jobs(t):
    """R2: the critical jobs of each deadline, a row each."""
    return D.critical_jobs(M.job_metrics(fx.runs(t), p95="none"), fx.deadlines(t))


@register("src_registry", O.with_(O.SUP, O.EDGES) + "SELECT parent, child FROM edges")
def q_src_registry(t):
    """The registry written as JSON lines and read by its schema gives the edges."""
    path = scratch_dir(t.spark, "registry")
    IO.write_ndjson(fx.registry(t), path)
    return G.edges(SC.read_good(t.spark, "registry", path))


@register("src_signals", O.with_(O.EV) + f""", e AS (SELECT *, max(ts) OVER () AS newest FROM ev),
i AS (SELECT count(*) FILTER (WHERE pk % 2 = 0) AS s, count(*) FILTER (WHERE pk % 2 = 0 IS NOT TRUE) AS c FROM e
  WHERE event_type = 'error' AND ts > newest - INTERVAL 720 MINUTE),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE pk >= 50) AS f, max(ts) AS m FROM e
  WHERE event_type = 'purchase' AND ts > newest - INTERVAL 720 MINUTE)
SELECT CAST(s AS BIGINT) AS storage_errors, CAST(i.c AS BIGINT) AS compute_errors, n AS ci_runs, f AS ci_failures,
  strftime(m, {TSF}) AS newest_ci FROM i, c""")
def q_src_signals(t):
    """Infra metrics as JSON lines and CI runs as parquet, read by their schemas: the last 720 minutes of both."""
    infra, ci = scratch_dir(t.spark, "infra"), scratch_dir(t.spark, "ci")
    IO.write_ndjson(fx.infra_metrics(t), infra)
    IO.write_snapshot(fx.ci_runs(t).withColumn("created_at", F.col("created_at").cast("string")), ci)
    newest = fx.events_max_ts(t)
    errors = S.infra_signals(SC.read_good(t.spark, "infra_metrics", infra), newest, 720)
    recent = S.ci_window(SC.read_good(t.spark, "ci_runs", ci, "parquet"), newest, 720)
    return errors.withColumns({
        "ci_runs": recent.select(F.count(F.lit(1))).scalar(), "newest_ci": recent.select(F.max("created_at")).scalar(),
        "ci_failures": recent.select(F.count_if(F.col("conclusion") == "failure")).scalar()})
