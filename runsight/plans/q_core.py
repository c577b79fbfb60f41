"""Core queries: metrics, aggregates, drift, verdicts and their read models."""

from __future__ import annotations

from pyspark.sql import functions as F

from runsight.operators import metrics as M
from runsight.operators import verdicts as V
from runsight.plans import oracle as O
from runsight.plans.catalog import register
from runsight.sources import fixtures as fx

B = O.BASE


def gold(t, p95="exact"):
    return M.job_metrics(fx.runs(t), p95=p95)


METRIC_COLS = ["job_name", "team", "impact", "sla_minutes", "total_runs", "duration_runs", "latest_duration",
               "latest_rows", "latest_status", "latest_start_time", "avg_duration", "p95_duration",
               "stddev_duration", "avg_rows", "stddev_rows", "failure_rate", "time_drift_score",
               "volume_drift_score", "verdict", "priority_score"]


@register("job_metrics", B + f"SELECT {O.METRICS_COLS} FROM m")
def q_job_metrics(t):
    """A1: per-job baseline, drift, verdict and priority over all runs."""
    return gold(t).select(*METRIC_COLS)


@register("gold_verdicts", B + """SELECT job_name, team, impact, verdict, time_drift_score, volume_drift_score,
  priority_score, latest_duration, sla_minutes, latest_rows, avg_rows, latest_status, failure_rate
  FROM m WHERE verdict <> 'safe'""")
def q_gold_verdicts(t):
    """Non-safe subset by priority."""
    return V.gold_verdicts(gold(t)).drop("verdict_computed_at")


@register("verdict_counts", B + """SELECT v.verdict, CAST(count(m.job_name) AS BIGINT) AS jobs
  FROM (VALUES ('safe'), ('at_risk'), ('breached'), ('insufficient_data')) v(verdict)
  LEFT JOIN m ON m.verdict = v.verdict GROUP BY v.verdict""")
def q_verdict_counts(t):
    """A2: jobs per verdict in one pass."""
    return V.verdict_counts(gold(t))


RUNS_ONLY = O.with_(O.SUP, O.RUNS)


@register("agg_run_count", RUNS_ONLY + "SELECT job_name, count(*) AS total_runs FROM runs GROUP BY job_name")
def q_agg_run_count(t):
    """Runs per job."""
    return fx.runs(t).groupBy("job_name").agg(F.count(F.lit(1)).alias("total_runs"))


@register("agg_means", RUNS_ONLY + f"""SELECT job_name, {O.R('avg(duration_minutes)', 6)} AS avg_duration,
  {O.R('avg(rows_processed)', 6)} AS avg_rows FROM runs GROUP BY job_name""")
def q_agg_means(t):
    """Mean duration and rows."""
    from runsight.functions import rnd
    return fx.runs(t).groupBy("job_name").agg(rnd(F.avg("duration_minutes"), 6).alias("avg_duration"),
                                              rnd(F.avg("rows_processed"), 6).alias("avg_rows"))


@register("agg_p95_exact", RUNS_ONLY + f"""SELECT job_name,
  {O.R('quantile_cont(duration_minutes, 0.95)', 6)} AS p95_duration FROM runs GROUP BY job_name""")
def q_agg_p95_exact(t):
    """Interpolated p95."""
    m = M.job_metrics(fx.runs(t), min_runs=0, rounding=False)
    from runsight.functions import rnd
    return m.select("job_name", rnd("p95_duration", 6).alias("p95_duration"))


@register("agg_p95_approx", RUNS_ONLY + """SELECT job_name, quantile_disc(duration_minutes, 0.95) AS p95_duration
  FROM runs GROUP BY job_name""")
def q_agg_p95_approx(t):
    """A1d: approximate p95 (bounded sketch state)."""
    m = M.job_metrics(fx.runs(t), min_runs=0, rounding=False, p95="approx")
    return m.select("job_name", "p95_duration")


@register("agg_p95_banded", RUNS_ONLY + f"""SELECT job_name,
  {O.R('quantile_cont(duration_minutes, 0.95)', 6)} AS p95_duration FROM runs GROUP BY job_name""")
def q_agg_p95_banded(t):
    """The exact p95 with bounded state: a sketch brackets it, a second pass counts only the bracket's values."""
    from runsight.functions import rnd
    m = M.job_metrics(fx.runs(t), min_runs=0, rounding=False, p95="banded")
    return m.select("job_name", rnd("p95_duration", 6).alias("p95_duration"))


@register("agg_stddev", RUNS_ONLY + f"""SELECT job_name, {O.R('stddev_samp(duration_minutes)', 6)} AS stddev_duration,
  {O.R('stddev_samp(rows_processed)', 6)} AS stddev_rows FROM runs GROUP BY job_name""")
def q_agg_stddev(t):
    """A1e: sample standard deviation."""
    from runsight.functions import rnd
    m = M.job_metrics(fx.runs(t), min_runs=0, rounding=False, p95="none")
    return m.select("job_name", rnd("stddev_duration", 6).alias("stddev_duration"),
                    rnd("stddev_rows", 6).alias("stddev_rows"))


@register("agg_failure_rate", RUNS_ONLY + f"""SELECT job_name,
  {O.R("avg(CASE WHEN status = 'failed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", 6)} AS failure_rate
  FROM runs GROUP BY job_name""")
def q_agg_failure_rate(t):
    """A1f: share of failed runs."""
    return M.job_metrics(fx.runs(t), min_runs=0, p95="none").select("job_name", "failure_rate")


@register("agg_latest", RUNS_ONLY + """SELECT job_name, arg_max(duration_minutes, (start_time, run_id)) AS latest_duration,
  arg_max(rows_processed, (start_time, run_id)) AS latest_rows, arg_max(status, (start_time, run_id)) AS latest_status,
  arg_max(run_id, (start_time, run_id)) AS latest_run_id,
  strftime(max(start_time), '%Y-%m-%d %H:%M:%S.%f') AS latest_start_time FROM runs GROUP BY job_name""")
def q_agg_latest(t):
    """A1g/W1: latest run per job by (start_time, run_id), via max_by (no window sort)."""
    latest = F.max_by(F.struct("duration_minutes", "rows_processed", "status", "run_id", "start_time"),
                      F.struct("start_time", "run_id"))
    return (fx.runs(t).groupBy("job_name").agg(latest.alias("l"))
            .select("job_name", F.col("l.duration_minutes").alias("latest_duration"),
                    F.col("l.rows_processed").alias("latest_rows"), F.col("l.status").alias("latest_status"),
                    F.col("l.run_id").alias("latest_run_id"), F.col("l.start_time").alias("latest_start_time")))


B600 = O.with_(O.SUP, O.RUNS, O.metrics_cte(min_runs=600))


@register("agg_warmup_gate", B600 + """SELECT job_name, total_runs, avg_duration, p95_duration, time_drift_score,
  verdict FROM m""")
def q_agg_warmup_gate(t):
    """A1h: statistics are NULL below min_runs (600 here: about half the jobs are warming up)."""
    m = M.job_metrics(fx.runs(t), min_runs=600)
    return m.select("job_name", "total_runs", "avg_duration", "p95_duration", "time_drift_score", "verdict")


@register("distinct_jobs", RUNS_ONLY + "SELECT count(DISTINCT job_name) AS n FROM runs")
def q_distinct_jobs(t):
    """A3: distinct jobs in the run table."""
    return V.distinct_jobs(fx.runs(t))


@register("warmup_progress", B600 + """SELECT count(*) FILTER (WHERE verdict <> 'insufficient_data') AS warmed,
  count(*) AS total, min(total_runs) AS min_runs_so_far FROM m""")
def q_warmup_progress(t):
    """A4: warmed jobs out of all jobs."""
    return V.warmup_progress(M.job_metrics(fx.runs(t), min_runs=600))


@register("warmup_table", B600 + "SELECT job_name, team, total_runs AS runs_so_far, verdict FROM m")
def q_warmup_table(t):
    """Warm-up listing with the display rename."""
    return V.warmup_table(M.job_metrics(fx.runs(t), min_runs=600))


@register("drift_scores", B + "SELECT job_name, time_drift_score, volume_drift_score FROM m")
def q_drift_scores(t):
    """Time and volume z-scores of the latest run."""
    return M.drift_scores(gold(t, "none"))


@register("verdicts", B + "SELECT job_name, verdict FROM m")
def q_verdicts(t):
    """Verdict per job."""
    return gold(t, "none").select("job_name", "verdict")


@register("priority", B + "SELECT job_name, impact, priority_score FROM m")
def q_priority(t):
    """Impact-weighted priority."""
    return gold(t, "none").select("job_name", "impact", "priority_score")


def _replay_sql(runs: str) -> str:
    return RUNS_ONLY + f"""SELECT job_name, run_id, strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') AS start_time,
  prior_runs,
  CASE WHEN prior_runs >= 30 THEN (CASE WHEN s > 0 THEN {O.R('(duration_minutes - a) / s', 3)} ELSE 0.0 END) END
    AS time_drift_score,
  CASE WHEN prior_runs >= 30 THEN (CASE WHEN sr > 0 THEN {O.R('(rows_processed - ar) / sr', 3)} ELSE 0.0 END) END
    AS volume_drift_score
FROM (SELECT *, count(duration_minutes) OVER w AS prior_runs, avg(duration_minutes) OVER w AS a,
        stddev_samp(duration_minutes) OVER w AS s, avg(rows_processed::DOUBLE) OVER w AS ar,
        stddev_samp(rows_processed::DOUBLE) OVER w AS sr
      FROM {runs} WINDOW w AS (PARTITION BY job_name ORDER BY start_time NULLS FIRST, run_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@register("replay_scores", _replay_sql("runs"))
def q_replay_scores(t):
    """Every run scored against the history before it."""
    return M.replay_scores(fx.runs(t))


@register("replay_scores_undated", _replay_sql(
    "(SELECT * REPLACE (CASE WHEN line_no <> 7 THEN start_time END AS start_time) FROM runs)"))
def q_replay_scores_undated(t):
    """C6 when some runs have no start time: they come first."""
    return M.replay_scores(fx.undated_runs(fx.runs(t)))


@register("urgent_jobs", B + """SELECT job_name, team, verdict, latest_duration, sla_minutes FROM m
  WHERE verdict IN ('breached', 'at_risk')""")
def q_urgent_jobs(t):
    """Breached or at-risk jobs."""
    return V.urgent_jobs(gold(t, "none"))


@register("urgent_topk", B + f"""SELECT job_name, team, verdict, {O.R('time_drift_score', 2)} AS time_drift,
  {O.R('volume_drift_score', 2)} AS vol_drift, priority_score FROM m WHERE verdict <> 'safe'
  ORDER BY priority_score DESC NULLS LAST, job_name LIMIT 10""")
def q_urgent_topk(t):
    """Ten most urgent non-safe jobs (the top-k report)."""
    return V.urgent_topk(gold(t), 10)


@register("heatmap", B + """SELECT CASE verdict WHEN 'breached' THEN 'red' WHEN 'at_risk' THEN 'yellow'
  WHEN 'safe' THEN 'green' WHEN 'insufficient_data' THEN 'black' END AS status, job_name, team, verdict,
  latest_duration, sla_minutes, priority_score, total_runs FROM m""")
def q_heatmap(t):
    """Heatmap rows with the verdict mark."""
    return V.heatmap(gold(t))


@register("job_drilldown", B + """SELECT job_name, latest_duration, sla_minutes, verdict, priority_score FROM m
  WHERE job_name = 'Supplier#000000003'""")
def q_job_drilldown(t):
    """One job's card, from that job's runs only."""
    job = "Supplier#000000003"
    return V.job_drilldown(M.job_metrics(fx.runs(t).filter(F.col("job_name") == job), p95="none"), job)


@register("total_events", RUNS_ONLY + """SELECT count(*) AS total_events, sum(rows_processed) AS total_rows,
  count(DISTINCT job_name) AS jobs FROM runs""")
def q_total_events(t):
    """Log totals in one pass."""
    return fx.runs(t).agg(F.count(F.lit(1)).alias("total_events"), F.sum("rows_processed").alias("total_rows"),
                          F.count_distinct("job_name").alias("jobs"))


@register("union_runs", RUNS_ONLY + """SELECT job_name, count(*) AS runs FROM
  (SELECT job_name FROM runs WHERE line_no % 2 = 0 UNION ALL SELECT job_name FROM runs WHERE line_no % 2 = 1)
  GROUP BY job_name""")
def q_union_runs(t):
    """Two increments accumulated by name (unionByName), then counted."""
    r = fx.runs(t)
    a = r.filter(F.col("line_no") % 2 == 0).drop("line_no")
    b = r.filter(F.col("line_no") % 2 == 1).select(*reversed(a.columns))
    return a.unionByName(b).groupBy("job_name").agg(F.count(F.lit(1)).alias("runs"))


@register("dedupe_runs", RUNS_ONLY + """SELECT job_name, count(*) AS runs FROM
  (SELECT DISTINCT job_name, run_id FROM (SELECT job_name, run_id FROM runs UNION ALL
    SELECT job_name, run_id FROM runs WHERE line_no <= 4)) GROUP BY job_name""")
def q_dedupe_runs(t):
    """U4: re-appended windows deduplicated on the run key."""
    from runsight.operators.sets import dedupe_runs
    r = fx.runs(t)
    return (dedupe_runs(r.unionByName(r.filter(F.col("line_no") <= 4)))
            .groupBy("job_name").agg(F.count(F.lit(1)).alias("runs")))


@register("new_runs_antijoin", RUNS_ONLY + """SELECT job_name, count(*) AS runs FROM runs a
  WHERE NOT EXISTS (SELECT 1 FROM runs s WHERE s.line_no <= 3 AND s.job_name = a.job_name AND s.run_id = a.run_id)
  GROUP BY job_name""")
def q_new_runs_antijoin(t):
    """Unseen runs = all minus seen (left_anti on the run key)."""
    from runsight.operators.sets import new_runs
    r = fx.runs(t)
    return new_runs(r, r.filter(F.col("line_no") <= 3)).groupBy("job_name").agg(F.count(F.lit(1)).alias("runs"))
