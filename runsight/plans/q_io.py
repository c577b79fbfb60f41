"""Source and sink round trips.

Each query writes data derived from the driver tables into a fresh folder
under the shared checkpoint folder, reads it back through the library's
readers and aggregates it; the oracle aggregates the same data directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from runsight.functions import rnd
from runsight.plans import oracle as O
from runsight.plans.catalog import register
from runsight.session import scratch_dir
from runsight.sources import files as IO
from runsight.sources import fixtures as fx

RUNS_ONLY = O.with_(O.SUP, O.RUNS)
JOB_AGG_SQL = RUNS_ONLY + f"""SELECT job_name, count(*) AS runs, {O.R('sum(duration_minutes)', 4)} AS duration_sum,
  sum(rows_processed) AS rows_sum, strftime(max(start_time), '%Y-%m-%d %H:%M:%S.%f') AS last_start FROM runs
  GROUP BY job_name"""

JSON_COLS = ["job_name", "team", "impact", "sla_minutes", "normal_rows", "run_id", "start_time", "duration_minutes",
             "rows_processed", "status"]


def _job_agg(df):
    return df.groupBy("job_name").agg(F.count(F.lit(1)).alias("runs"),
                                      rnd(F.sum("duration_minutes"), 4).alias("duration_sum"),
                                      F.sum("rows_processed").alias("rows_sum"),
                                      F.max("start_time").alias("last_start"))


@register("src_json_roundtrip", JOB_AGG_SQL)
def q_src_json_roundtrip(t):
    """Runs written as JSON-array files, read back with multiLine and a fixed schema."""
    spark = t.spark
    path = scratch_dir(spark, "json-arrays")
    IO.write_json_arrays(fx.runs(t).select(*JSON_COLS), path)
    back = IO.read_runs_json(spark, path)
    return _job_agg(back.filter(F.col("_corrupt_record").isNull()))


@register("src_ndjson_roundtrip", JOB_AGG_SQL)
def q_src_ndjson_roundtrip(t):
    """NDJSON write and read."""
    spark = t.spark
    path = scratch_dir(spark, "ndjson")
    IO.write_ndjson(fx.runs(t).select(*JSON_COLS), path)
    return _job_agg(IO.read_runs_ndjson(spark, path))


@register("sink_parquet_roundtrip", JOB_AGG_SQL)
def q_sink_parquet_roundtrip(t):
    """S3: overwrite snapshot (written twice; the second write replaces the first)."""
    spark = t.spark
    path = scratch_dir(spark, "snapshot")
    r = fx.runs(t)
    IO.write_snapshot(r.filter(F.col("line_no") == 1), path)
    IO.write_snapshot(r, path)
    return _job_agg(spark.read.parquet(path))


def _recent_sql(both: bool) -> str:
    where = "" if both else " WHERE line_no % 2 = 1"
    return RUNS_ONLY + f"""SELECT job_name, count(*) AS runs, {O.R('sum(duration_minutes)', 4)} AS duration_sum,
  sum(rows_processed) AS rows_sum, strftime(max(start_time), '%Y-%m-%d %H:%M:%S.%f') AS last_start FROM runs{where}
GROUP BY job_name"""


def _partitioned(t, days):
    """Two appends on two processing dates; read back the last ``days`` days."""
    spark = t.spark
    path = scratch_dir(spark, "silver")
    r = fx.runs(t)
    IO.append_partitioned(r.filter(F.col("line_no") % 2 == 0), path, as_of="2001-11-03 08:00:00")
    IO.append_partitioned(r.filter(F.col("line_no") % 2 == 1), path, as_of="2001-11-05 08:00:00")
    return _job_agg(IO.read_recent(spark, path, "2001-11-05 09:00:00", days).drop("year", "month", "day"))


@register("sink_partitioned_pruned", _recent_sql(False))
def q_sink_partitioned_pruned(t):
    """Appends filed by processing date; a partition-only predicate keeps today's folder."""
    return _partitioned(t, 0)


@register("silver_recent", _recent_sql(True))
def q_silver_recent(t):
    """The last 7 days of the partitioned silver table (both appends)."""
    return _partitioned(t, 7)


@register("sink_atomic_replace", JOB_AGG_SQL)
def q_sink_atomic_replace(t):
    """Two versions published through the pointer; readers see the second."""
    spark = t.spark
    path = scratch_dir(spark, "gold")
    r = fx.runs(t)
    IO.replace_atomic(r.filter(F.col("line_no") == 1), path)
    IO.replace_atomic(r, path)
    return _job_agg(IO.read_current(spark, path))


@register("incident_sink", O.with_(O.SUP, O.RUNS, O.metrics_cte(), O.INCIDENTS) + """SELECT job_name,
  strftime(detected_at, '%Y-%m-%d %H:%M:%S.%f') AS detected_at, strftime(CAST(detected_at AS DATE), '%Y-%m-%d')
  AS detected_date FROM inc""")
def q_incident_sink(t):
    """Incidents appended partitioned by detection date and read back."""
    from runsight.operators.metrics import job_metrics
    spark = t.spark
    urgent = job_metrics(fx.runs(t)).filter(F.col("verdict").isin("breached", "at_risk"))
    path = scratch_dir(spark, "incidents")
    IO.write_incidents(fx.incidents(t, urgent), path)
    back = spark.read.parquet(path)
    return back.select("job_name", "detected_at", F.col("detected_date").cast("date").alias("detected_date"))


@register("silver_clean", RUNS_ONLY + """SELECT job_name, run_id, TRY_CAST(CASE WHEN line_no = 7 THEN 'n/a'
  ELSE CAST(duration_minutes AS VARCHAR) END AS DOUBLE) AS duration_minutes, rows_processed,
  line_no = 7 AS quarantined, '2001-11-05 00:00:00.000000' AS processed_at FROM runs""")
def q_silver_clean(t):
    """Raw text values cast to silver types; values that do not cast are quarantined."""
    r = fx.runs(t)
    raw = r.select("job_name", "team", "impact", F.col("sla_minutes").cast("string").alias("sla_minutes"),
                   "run_id", F.col("start_time").cast("string").alias("start_time"),
                   F.when(F.col("line_no") == 7, F.lit("n/a")).otherwise(F.col("duration_minutes").cast("string"))
                   .alias("duration_minutes"),
                   F.col("rows_processed").cast("string").alias("rows_processed"), "status")
    c = IO.clean_runs(raw, fx.INCIDENT_AS_OF)
    return c.select("job_name", "run_id", "duration_minutes", "rows_processed", "quarantined", "processed_at")


@register("incident_open", O.with_(O.SUP, O.RUNS, O.metrics_cte(), O.INCIDENTS) + """SELECT job_name, team,
  strftime(detected_at, '%Y-%m-%d %H:%M:%S.%f') AS detected_at FROM inc WHERE resolved_at IS NULL""")
def q_incident_open(t):
    """Open incidents read back from the incident table (appended, partitioned by date)."""
    from runsight.operators.metrics import job_metrics
    spark = t.spark
    urgent = job_metrics(fx.runs(t)).filter(F.col("verdict").isin("breached", "at_risk"))
    path = scratch_dir(spark, "incidents-open")
    IO.write_incidents(fx.incidents(t, urgent), path)
    return spark.read.parquet(path).filter(F.col("resolved_at").isNull()).select("job_name", "team", "detected_at")
