"""Deadline risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import lit_ts, minutes_between, rnd

HIGH_BUFFER, MEDIUM_BUFFER = 30, 90


def explode_deadlines(deadlines: DataFrame) -> DataFrame:
    """Array form (name, hour, minute, tz, jobs array) -> long form with the job's position (NULL: no jobs)."""
    return deadlines.select("deadline_name", "hour", "minute", "tz",
                            F.posexplode_outer("jobs").alias("pos", "job_name"))


def deadline_risk(metrics: DataFrame, deadlines: DataFrame, as_of) -> DataFrame:
    """Next occurrence of each deadline after as_of, buffer, critical jobs and risk.

    deadlines: long form (deadline_name, hour, minute, tz, job_name, pos); the
    clock time is local to ``tz``.  critical_jobs lists the deadline's jobs that
    are at_risk or breached, in configured order.
    """
    now = lit_ts(as_of)
    v = metrics.select("job_name", "verdict")
    d = deadlines.join(v, "job_name", "left")
    crit = F.when(F.col("verdict").isin("at_risk", "breached"), F.struct("pos", "job_name"))
    g = d.groupBy("deadline_name", "hour", "minute", "tz").agg(
        F.array_sort(F.collect_list(crit)).alias("crit"))
    local_now = F.from_utc_timestamp(now, F.col("tz"))
    today = F.make_timestamp(F.year(local_now), F.month(local_now), F.dayofmonth(local_now),
                             F.col("hour"), F.col("minute"), F.lit(0))
    local_dl = F.when(today < local_now, today + F.expr("INTERVAL 1 DAY")).otherwise(today)
    dl = F.to_utc_timestamp(local_dl, F.col("tz"))
    out = g.select("deadline_name", "tz", dl.alias("deadline_time"),
                   minutes_between(dl, now).alias("_buf"),
                   F.array_join(F.col("crit.job_name"), ",").alias("critical_jobs"))
    risk = (F.when((F.col("_buf") < HIGH_BUFFER) | (F.col("critical_jobs") != ""), "high")
            .when(F.col("_buf") < MEDIUM_BUFFER, "medium").otherwise("low"))
    return out.select("deadline_name", "tz", "deadline_time", rnd("_buf", 1).alias("buffer_minutes"),
                      "critical_jobs", risk.alias("risk_level"), now.alias("checked_at"))


def critical_jobs(metrics: DataFrame, deadlines: DataFrame) -> DataFrame:
    """R2 as a table: one row a deadline and critical job, (deadline_name, pos, job_name, verdict); no list is gathered."""
    v = metrics.filter(F.col("verdict").isin("at_risk", "breached")).select("job_name", "verdict")
    return deadlines.join(v, "job_name").select("deadline_name", "pos", "job_name", "verdict")
