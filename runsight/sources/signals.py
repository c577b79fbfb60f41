"""External signal tables: infra error counters and CI runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import lit_ts, minutes_between
from runsight.operators.asof import asof_join
from runsight.operators.chunked import CHUNK_ROWS

STORAGE, COMPUTE = "storage_errors", "compute_errors"


def infra_signals(metrics: DataFrame, as_of, minutes: int = 30) -> DataFrame:
    """One row (storage_errors, compute_errors) summed over (as_of - minutes, as_of].

    ``metrics`` holds ts, metric, value.  An empty window gives zeros.
    """
    t = lit_ts(as_of)
    lo = t - F.make_dt_interval(mins=F.lit(minutes))
    w = metrics.filter((F.col("ts") > lo) & (F.col("ts") <= t))
    return w.agg(
        F.coalesce(F.sum(F.when(F.col("metric") == STORAGE, F.col("value"))), F.lit(0.0)).cast("long").alias(STORAGE),
        F.coalesce(F.sum(F.when(F.col("metric") == COMPUTE, F.col("value"))), F.lit(0.0)).cast("long").alias(COMPUTE))


def ci_recent(ci: DataFrame, as_of, n: int = 10) -> DataFrame:
    """The n newest CI runs created at or before as_of (the CI page size)."""
    return (ci.filter(F.col("created_at") <= lit_ts(as_of))
            .orderBy(F.col("created_at").desc(), F.col("name").desc()).limit(n))


def ci_window(ci: DataFrame, as_of, minutes: int) -> DataFrame:
    """CI runs created in the ``minutes`` up to as_of, however many they are."""
    t = lit_ts(as_of)
    return ci.filter((F.col("created_at") > t - F.make_dt_interval(mins=F.lit(minutes))) & (F.col("created_at") <= t))


def nearest_failure(ci: DataFrame, as_of) -> DataFrame:
    """One row: minutes between as_of and the nearest failed CI run (NULL if none)."""
    f = ci.filter(F.col("conclusion") == "failure")
    return f.agg(F.min(F.abs(minutes_between(lit_ts(as_of), "created_at"))).alias("ci_minutes"))


def nearest_failure_per_run(runs: DataFrame, ci: DataFrame, target_rows: int = CHUNK_ROWS) -> DataFrame:
    """J12 per run: the failed CI run nearest to each run's start, before or after it (of equal ones the earlier).

    Adds ci_name, ci_at and ci_minutes (NULL without a failed CI run or a start time).  Of failures at one instant the one
    with the greatest name counts.  All runs share one timeline, which the as-of join cuts into chunks.
    """
    failed = ci.filter(F.col("conclusion") == "failure").select(
        F.col("created_at").alias("_at"), F.col("name").alias("ci_name"), F.col("created_at").alias("ci_at"))
    near = asof_join(runs, failed, None, "start_time", "_at", ["ci_name", "ci_at"], "nearest", target_rows)
    return near.withColumn("ci_minutes", F.abs(minutes_between("start_time", "ci_at")))
