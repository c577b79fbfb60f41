"""Run-history extract from scheduler task records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import lit_ts, rnd
from runsight.operators.asof import asof_join

COMPLETED = ("success", "failed")


def extract_runs(task_instances: DataFrame, registry: DataFrame, as_of, lookback_hours: int = 24,
                 states=COMPLETED) -> DataFrame:
    """Task records -> run records of known jobs, enriched from the registry.

    Lookback cut and state filter at the source, then drop NULL durations and
    unknown jobs, seconds to minutes (4 dp) and enrich.  All rows: no page cap.
    """
    t = lit_ts(as_of)
    ti = task_instances.filter((F.col("start_date") >= t - F.make_dt_interval(hours=F.lit(lookback_hours)))
                               & F.col("state").isin(*states))
    reg = registry.select(F.col("job_name").alias("dag_id"), "team", "impact", "sla_minutes", "normal_rows")
    return (ti.filter(F.col("duration").isNotNull())
            .join(reg, "dag_id")  # inner join = known jobs only (semi join + enrich in one)
            .select(F.col("dag_id").alias("job_name"), "run_id", F.col("start_date").alias("start_time"),
                    rnd(F.col("duration") / 60.0, 4).alias("duration_minutes"), F.col("state").alias("status"),
                    "team", "impact", "sla_minutes", "normal_rows"))


def known_runs(runs: DataFrame, registry: DataFrame) -> DataFrame:
    """Runs of jobs present in the registry (left semi join)."""
    return runs.join(registry.select("job_name"), "job_name", "left_semi")


def enrich(runs: DataFrame, registry: DataFrame) -> DataFrame:
    """Add team, impact and SLA from the registry."""
    return runs.join(registry.select("job_name", "team", "impact", "sla_minutes"), "job_name")


def attach_rows_processed(runs: DataFrame, results: DataFrame, registry: DataFrame, all_known: bool = False) -> DataFrame:
    """Each run gets rows_processed of its job's latest result at or before the run's end;
    the registry's normal_rows when there is none.  ``all_known``: every run has a job, a start and a duration."""
    end = F.timestamp_micros(F.unix_micros("start_time")
                             + (F.col("duration_minutes") * 60_000_000).cast("long"))
    r = runs.withColumn("run_end", end)
    j = asof_join(r, results, "job_name", "run_end", "recorded_at", ["rows_processed"], all_known=all_known)
    nr = registry.select("job_name", F.col("normal_rows").alias("_nr"))
    return (j.join(nr, "job_name", "left")
            .withColumn("rows_processed", F.coalesce("rows_processed", "_nr")).drop("_nr"))
