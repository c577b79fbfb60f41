"""Read models over the gold metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import SEVERITY, rnd

URGENT = ("breached", "at_risk")
VERDICTS = ("safe", "at_risk", "breached", "insufficient_data")
# Fixed status marks of the heatmap page.
STATUS_MARK = {"breached": "red", "at_risk": "yellow", "safe": "green", "insufficient_data": "black"}


def verdict_counts(metrics: DataFrame) -> DataFrame:
    """One pass: count per verdict (all four verdicts, zero included)."""
    counts = metrics.groupBy("verdict").agg(F.count(F.lit(1)).alias("jobs"))
    allv = metrics.sparkSession.createDataFrame([(v,) for v in VERDICTS], "verdict string")
    return (F.broadcast(allv).join(counts, "verdict", "left")
            .select("verdict", F.coalesce("jobs", F.lit(0)).cast("long").alias("jobs")))


def verdict_summary(metrics: DataFrame) -> DataFrame:
    """One-row summary with a column per verdict (count_if in a single pass)."""
    return metrics.agg(F.count(F.lit(1)).alias("total_jobs"),
                       *[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS])


def distinct_jobs(runs: DataFrame, approx: bool = False) -> DataFrame:
    c = F.approx_count_distinct("job_name") if approx else F.count_distinct("job_name")
    return runs.agg(c.alias("n"))


def warmup_progress(metrics: DataFrame) -> DataFrame:
    """Warmed jobs over all jobs; runs_so_far is the dashboard's name for total_runs."""
    return metrics.agg(F.count_if(F.col("verdict") != "insufficient_data").alias("warmed"),
                       F.count(F.lit(1)).alias("total"),
                       F.min("total_runs").alias("min_runs_so_far"))


def warmup_table(metrics: DataFrame) -> DataFrame:
    return metrics.select("job_name", "team", F.col("total_runs").alias("runs_so_far"), "verdict")


def gold_verdicts(metrics: DataFrame, as_of=None) -> DataFrame:
    """Non-safe subset (14 columns), by priority descending."""
    stamp = F.lit(None).cast("timestamp") if as_of is None else F.lit(as_of).cast("timestamp")
    return (metrics.filter(F.col("verdict") != "safe")
            .select("job_name", "team", "impact", "verdict", "time_drift_score", "volume_drift_score",
                    "priority_score", "latest_duration", "sla_minutes", "latest_rows", "avg_rows",
                    "latest_status", "failure_rate", stamp.alias("verdict_computed_at"))
            .orderBy(F.col("priority_score").desc_nulls_last(), "job_name"))


def urgent_jobs(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("verdict").isin(*URGENT)).select(
        "job_name", "team", "verdict", "latest_duration", "sla_minutes")


def urgent_topk(metrics: DataFrame, k: int = 10) -> DataFrame:
    """Top-k non-safe jobs by priority (the console report); job_name breaks ties."""
    return (metrics.filter(F.col("verdict") != "safe")
            .orderBy(F.col("priority_score").desc_nulls_last(), F.col("job_name"))
            .limit(k)
            .select("job_name", "team", "verdict", rnd("time_drift_score", 2).alias("time_drift"),
                    rnd("volume_drift_score", 2).alias("vol_drift"), "priority_score"))


def severity_rank(col: str = "verdict"):
    c = F.col(col)
    e = F.when(c == "breached", SEVERITY["breached"])
    for v in ("at_risk", "insufficient_data", "safe"):
        e = e.when(c == v, SEVERITY[v])
    return e.otherwise(9)


def heatmap(metrics: DataFrame, order: str = "severity") -> DataFrame:
    """Heatmap rows with a status mark; ``order='alpha'`` keeps verdict DESC as text."""
    mark = F.create_map(*[x for kv in STATUS_MARK.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    out = metrics.select(mark[F.col("verdict")].alias("status"), "job_name", "team", "verdict",
                         "latest_duration", "sla_minutes", "priority_score", "total_runs")
    if order == "alpha":
        return out.orderBy(F.col("verdict").desc(), F.col("priority_score").desc_nulls_last(), "job_name")
    return out.orderBy(severity_rank(), F.col("priority_score").desc_nulls_last(), "job_name")


def job_drilldown(metrics: DataFrame, job: str) -> DataFrame:
    return metrics.filter(F.col("job_name") == job).select(
        "job_name", "latest_duration", "sla_minutes", "verdict", "priority_score")
