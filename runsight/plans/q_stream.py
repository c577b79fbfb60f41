"""Streaming queries (X1-X9): land fixture data as files, run the stream to completion
(availableNow), read the sink back.  Oracles describe the final sink contents."""

from __future__ import annotations

from pyspark.sql import functions as F

from runsight.functions import rnd
from runsight.plans import oracle as O
from runsight.plans.catalog import register
from runsight.plans.q_io import JOB_AGG_SQL, _job_agg
from runsight.sources import files as IO
from runsight.sources import fixtures as fx
from runsight.streaming import runs as ST

RUN_STREAM_COLS = ["job_name", "team", "impact", "sla_minutes", "run_id", "start_time", "duration_minutes",
                   "rows_processed", "status", "line_no"]


def _landed_runs(t, files=4):
    spark = t.spark
    src, _ = ST.scratch(spark, "runs-src")
    r = fx.runs(t).select(*RUN_STREAM_COLS)
    ST.land(r, src, files, "start_time")
    return src, r.schema


RUN_CUTS = ["1997-01-01", "1999-01-01", "2001-01-01"]
EVENT_CUTS = ["2024-01-09", "2024-01-17", "2024-01-25"]
#: Windows that the watermark (10 minutes behind the newest event) has closed.
CLOSED = "+ INTERVAL 10 MINUTE <= (SELECT max(ts) FROM {})"


def _append_windows(t, df, build, name):
    """Run a windowed stream in append mode over four landings; closed windows only, state is evicted."""
    src, _ = ST.scratch(t.spark, f"{name}-src")
    out, ck = ST.scratch(t.spark, name)

    def run():
        s = build(ST.read_stream(t.spark, src, df.schema))
        ST.run_available(s.writeStream.outputMode("append").format("parquet").option("path", out), ck)

    ST.in_steps(df, src, "ts", EVENT_CUTS, run)
    return t.spark.read.parquet(out)


@register("stream_incremental_ingest", JOB_AGG_SQL)
def q_stream_ingest(t):
    """New files picked up one per micro-batch into a parquet table."""
    spark = t.spark
    src, schema = _landed_runs(t)
    out, ck = ST.scratch(spark, "ingest")
    ST.ingest(spark, src, out, schema, ck, max_files=1)
    return _job_agg(spark.read.parquet(out))


def _gold_stream(t, incidents=None):
    spark = t.spark
    r = fx.runs(t).select(*RUN_STREAM_COLS)
    src, _ = ST.scratch(spark, "gold-src")
    gold, ck = ST.scratch(spark, "gold")
    ST.in_steps(r, src, "start_time", RUN_CUTS, lambda: ST.gold_refresh(
        spark, ST.read_stream(spark, src, r.schema), gold, ck, incidents, fx.INCIDENT_AS_OF))
    return IO.read_current(spark, gold)


@register("stream_job_metrics", O.with_(O.SUP, O.RUNS, O.metrics_cte()) + """SELECT job_name, total_runs,
  avg_duration, stddev_duration, avg_rows, latest_duration, latest_rows, time_drift_score, volume_drift_score
  FROM m""")
def q_stream_job_metrics(t):
    """Running per-job baselines over four micro-batches equal the batch result."""
    g = _gold_stream(t)
    return g.select("job_name", "total_runs", "avg_duration", "stddev_duration", "avg_rows", "latest_duration",
                    "latest_rows", "time_drift_score", "volume_drift_score")


@register("stream_gold_refresh", O.BASE + "SELECT job_name, verdict, priority_score FROM m")
def q_stream_gold_refresh(t):
    """Gold snapshot rewritten per micro-batch; the last one holds the verdicts."""
    return _gold_stream(t).select("job_name", "verdict", "priority_score")


def _urgent_sql(n: int, cut: str | None) -> str:
    part = f"runs_p AS (SELECT * FROM runs WHERE start_time < TIMESTAMP '{cut}')" if cut else "runs_p AS (SELECT * FROM runs)"
    return (f"SELECT {n} AS b, job_name, team, verdict FROM (" + O.with_(O.SUP, O.RUNS, part, O.metrics_cte(runs="runs_p"))
            + "SELECT job_name, team, verdict FROM m WHERE verdict IN ('breached', 'at_risk'))")


@register("stream_incidents", "SELECT job_name, arg_min(team, b) AS team, arg_min(verdict, b) AS verdict, "
          "'2001-11-05 00:00:00.000000' AS detected_at FROM ("
          + " UNION ALL ".join(_urgent_sql(n, c) for n, c in enumerate([*RUN_CUTS, None])) + ") GROUP BY job_name")
def q_stream_incidents(t):
    """Four batches; a job gets one incident, in the first batch that finds it urgent."""
    inc, _ = ST.scratch(t.spark, "incidents")
    _gold_stream(t, inc)
    return t.spark.read.parquet(inc).select("job_name", "team", "verdict", "detected_at")


def _win_sql(size_min: int, slide_min: int | None) -> str:
    if slide_min is None:
        wins = f"""SELECT account_id, time_bucket(INTERVAL {size_min} MINUTE, ts, TIMESTAMP '1970-01-01') AS ws FROM tx"""
    else:
        k = size_min // slide_min
        wins = f"""SELECT account_id, time_bucket(INTERVAL {slide_min} MINUTE, ts, TIMESTAMP '1970-01-01')
                   - to_minutes({slide_min} * i) AS ws FROM tx, range({k}) r(i)"""
    return O.with_(O.TX) + f""", w AS ({wins})
SELECT account_id, strftime(ws, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  strftime(ws + to_minutes({size_min}), '%Y-%m-%d %H:%M:%S.%f') AS window_end, count(*) AS txn_count
FROM w WHERE ws + to_minutes({size_min}) {CLOSED.format('tx')} GROUP BY account_id, ws"""


@register("stream_velocity_tumbling", _win_sql(5, None))
def q_stream_velocity_tumbling(t):
    """Transactions per account per closed 5-minute tumbling window (watermarked stream)."""
    return _append_windows(t, fx.transactions(t), lambda s: ST.windowed_counts(s, "5 minutes"), "vel-tumble")


@register("stream_velocity_sliding", _win_sql(5, 1))
def q_stream_velocity_sliding(t):
    """Closed 5-minute windows sliding by 1 minute ("any 5-minute window")."""
    return _append_windows(t, fx.transactions(t), lambda s: ST.windowed_counts(s, "5 minutes", "1 minute"), "vel-slide")


@register("stream_dedupe", O.with_(O.SUP, O.RUNS) + "SELECT job_name, count(*) AS runs FROM runs GROUP BY job_name")
def q_stream_dedupe(t):
    """Newer runs first, then late ones together with copies of runs already there; all are kept once."""
    spark = t.spark
    r = fx.runs(t).select(*RUN_STREAM_COLS)
    src, _ = ST.scratch(spark, "dedupe-src")
    out, ck = ST.scratch(spark, "dedupe")
    late = F.col("line_no") == 2
    for part in (r.filter(~late), r.filter(late | (F.col("line_no") == 3))):
        part.write.mode("append").option("compression", "zstd").parquet(src)
        ST.append_new_runs(spark, ST.read_stream(spark, src, r.schema), out, ck)
    return spark.read.parquet(out).groupBy("job_name").agg(F.count(F.lit(1)).alias("runs"))


@register("stream_corrections", O.with_(O.SUP, O.RUNS) + """SELECT job_name, count(*) AS runs, count_if(status = 'success') AS good,
  CAST(sum(CAST(CASE WHEN line_no = 3 AND was = 'failed' THEN duration_minutes + 1 ELSE duration_minutes END AS BIGINT))
       AS BIGINT) AS minutes
  FROM (SELECT * REPLACE (CASE WHEN line_no = 3 THEN 'success' ELSE status END AS status), status AS was FROM runs)
  GROUP BY job_name""")
def q_stream_corrections(t):
    """Runs land, then copies of some come again, the failed ones corrected: the newest copy counts."""
    spark = t.spark
    r = fx.runs(t)
    cols = RUN_STREAM_COLS
    src, _ = ST.scratch(spark, "correct-src")
    out, ck = ST.scratch(spark, "correct")
    bad = F.col("status") == "failed"
    again = r.filter(F.col("line_no") == 3).withColumns({
        "duration_minutes": F.when(bad, F.col("duration_minutes") + 1).otherwise(F.col("duration_minutes")),
        "status": F.lit("success")})
    for part in (r, again):
        part.select(*cols).write.mode("append").option("compression", "zstd").parquet(src)
        ST.append_new_runs(spark, ST.read_stream(spark, src, r.select(*cols).schema), out, ck)
    now = ST.current_runs(spark, out)
    return now.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "success").alias("good"),
        F.sum(F.col("duration_minutes").cast("long")).alias("minutes"))


@register("stream_velocity_trailing", O.with_(O.TX) + """SELECT account_id, txn_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
  trailing_count FROM (SELECT *, count(*) OVER (PARTITION BY account_id ORDER BY epoch_us(ts)
      RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS trailing_count FROM tx)
  WHERE trailing_count > 2 AND ts + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM tx)""")
def q_stream_velocity_trailing(t):
    """W4 in a stream: more than 2 transactions in the trailing 60 minutes, per transaction that the watermark has passed."""
    spark = t.spark
    df = fx.transactions(t)
    src, _ = ST.scratch(spark, "trailing-src")
    out, ck = ST.scratch(spark, "trailing")

    def run():
        flagged = ST.trailing_counts(ST.read_stream(spark, src, df.schema), 60).filter(F.col("trailing_count") > 2)
        ST.run_stateful(spark, flagged.writeStream.format("parquet").option("path", out), ck)

    ST.in_steps(df, src, "ts", EVENT_CUTS, run)
    return spark.read.parquet(out)


@register("stream_infra_30m", O.with_(O.EV) + """SELECT strftime(ws, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  strftime(ws + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS window_end,
  CAST(count(*) FILTER (WHERE pk % 2 = 0) AS BIGINT) AS storage_errors,
  CAST(count(*) FILTER (WHERE pk % 2 = 0 IS NOT TRUE) AS BIGINT) AS compute_errors
FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') AS ws FROM ev WHERE event_type = 'error')
WHERE ws + INTERVAL 30 MINUTE + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM ev WHERE event_type = 'error')
GROUP BY ws""")
def q_stream_infra_30m(t):
    """Infra errors per closed 30-minute window from a stream."""
    return _append_windows(t, fx.infra_metrics(t), ST.infra_windows, "infra")


@register("stream_run_drift", O.with_(O.SUP, O.RUNS) + f"""SELECT job_name, run_id,
  strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') AS start_time, prior_runs,
  CASE WHEN prior_runs >= 30 THEN (CASE WHEN s > 0 THEN {O.R('(duration_minutes - a) / s', 3)} ELSE 0.0 END) END
    AS time_drift_score,
  CASE WHEN prior_runs >= 30 THEN (CASE WHEN sr > 0 THEN {O.R('(rows_processed - ar) / sr', 3)} ELSE 0.0 END) END
    AS volume_drift_score
FROM (SELECT *, count(duration_minutes) OVER w AS prior_runs, avg(duration_minutes) OVER w AS a,
        stddev_samp(duration_minutes) OVER w AS s, avg(rows_processed::DOUBLE) OVER w AS ar,
        stddev_samp(rows_processed::DOUBLE) OVER w AS sr
      FROM runs WINDOW w AS (PARTITION BY job_name ORDER BY start_time, run_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
def q_stream_run_drift(t):
    """Each run scored on arrival against per-job (n, mean, M2) state."""
    spark = t.spark
    src, _ = ST.scratch(spark, "drift-src")
    r = fx.runs(t).select(*RUN_STREAM_COLS)
    schema = r.schema
    out, ck = ST.scratch(spark, "drift")

    def run():
        d = ST.run_drift(ST.read_stream(spark, src, schema))
        ST.run_stateful(spark, d.writeStream.format("parquet").option("path", out), ck)

    ST.in_steps(r, src, "start_time", RUN_CUTS, run)
    return spark.read.parquet(out)
