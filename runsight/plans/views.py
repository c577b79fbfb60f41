"""Gold tables as SQL views, and the dashboard's read models over them.

A page is a projection of one view, its filter and its order; columns and tables are the product's fixed names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runsight.operators.fingerprint import URGENT
from runsight.operators.incidents import incident_log

#: Worst verdict first on the heatmap.
SEVERITY_ORDER = ("breached", "at_risk", "insufficient_data")


def heatmap(spark: SparkSession) -> DataFrame:
    jobs = spark.table("gold_job_metrics")
    rank = F.coalesce(F.array_position(F.array(*[F.lit(v) for v in SEVERITY_ORDER]), F.col("verdict")), F.lit(0))
    worst = F.when(rank == 0, len(SEVERITY_ORDER) + 1).otherwise(rank)
    shown = ("job_name", "team", "verdict", "priority_score", "latest_duration", "sla_minutes", "total_runs")
    return jobs.orderBy(worst, F.col("priority_score").desc_nulls_last(), "job_name").select(*shown)


def urgent(spark: SparkSession) -> DataFrame:
    jobs = spark.table("gold_job_metrics").where(F.col("verdict").isin(*URGENT))
    return jobs.select("job_name", "team", "verdict", "latest_duration", "sla_minutes")


def fingerprints(spark: SparkSession) -> DataFrame:
    found = spark.table("gold_fingerprint")
    hidden = ("team", "verdict", "unrelated_slow", "cascade_root", "detected_at")
    return found.orderBy(F.desc("evidence_score"), "job_name").drop(*hidden)


def deadlines(spark: SparkSession) -> DataFrame:
    return spark.table("gold_deadline_risk").orderBy("buffer_minutes", "deadline_name").drop(
        "tz", "deadline_time", "checked_at")


def deadline_gate(spark: SparkSession) -> DataFrame:
    return spark.table("silver_job_runs").agg(F.count_distinct("job_name").alias("n"))


def sla(spark: SparkSession) -> DataFrame:
    health = spark.table("gold_sla_health").orderBy(F.desc("tightness_score"), "job_name")
    return health.drop("team", "impact", "avg_duration", "sla_minutes")


def incidents(spark: SparkSession) -> DataFrame:
    return incident_log(spark.table("incidents"), 20)


PAGES: dict[str, Callable[[SparkSession], DataFrame]] = {
    f.__name__: f for f in (heatmap, urgent, fingerprints, deadlines, deadline_gate, sla, incidents)}


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register each DataFrame as a temp view under its name; returns the names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def page(spark: SparkSession, name: str) -> DataFrame:
    return PAGES[name](spark)
