"""Incidents: open new ones, report text, resolve, log, MTTR."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runsight.functions.core import lit_ts, minutes_between, rnd
from runsight.sources import files as IO

# Fixed defaults when no fingerprint exists for a job.
DEFAULTS = {"fingerprint_type": "unknown", "evidence_score": "?",
            "statistical_evidence": "No fingerprint available", "external_evidence": "none",
            "recommended_action": "Investigate manually"}
REPORT_FIELDS = [("Job:", "job_name"), ("Team:", "team"), ("Verdict:", "verdict"), ("Fingerprint:", None),
                 ("Root cause:", "statistical_evidence"), ("Evidence:", "external_evidence"),
                 ("Action:", "recommended_action"), ("Route to:", "route_to_team"), ("Detected at:", "detected_at")]
RULE = "=" * 24
TITLE = "INCIDENT REPORT"


def incident_details(urgent: DataFrame, fp: DataFrame) -> DataFrame:
    """Urgent jobs with their fingerprint fields, defaults where none exists."""
    f = fp.select("job_name", "fingerprint_type", F.col("evidence_score").cast("string").alias("evidence_score"),
                  "statistical_evidence", "external_evidence", "recommended_action", "route_to_team")
    j = urgent.select("job_name", "team", "verdict").join(f, "job_name", "left")
    return j.select("job_name", "team", "verdict",
                    *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in DEFAULTS.items()],
                    F.coalesce("route_to_team", "team").alias("route_to_team"))


def incident_text(details: DataFrame) -> DataFrame:
    """K2: the ten-field report as one text column."""
    lines = [F.lit(TITLE), F.lit(RULE)]
    for label, col in REPORT_FIELDS:
        pad = F.lit(label.ljust(15))
        if col is None:
            val = F.concat(F.col("fingerprint_type"), F.lit(" (evidence score: "), F.col("evidence_score"), F.lit(")"))
        elif col == "detected_at":
            val = F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss")
        else:
            val = F.col(col)
        lines.append(F.concat(pad, val))
    lines.append(F.lit(RULE))
    return details.withColumn("report", F.concat_ws("\n", *lines))


def open_incidents(urgent: DataFrame, fp: DataFrame, incidents: DataFrame, as_of) -> DataFrame:
    """Incidents for urgent jobs that have no open incident yet (left anti join)."""
    open_ = incidents.filter(F.col("resolved_at").isNull()).select("job_name")
    d = incident_details(urgent, fp).join(open_, "job_name", "left_anti")
    d = d.withColumn("detected_at", lit_ts(as_of)).withColumn("resolved_at", F.lit(None).cast("timestamp"))
    return incident_text(d)


def resolve(incidents: DataFrame, resolutions: DataFrame) -> DataFrame:
    """K3: set resolved_at from (job_name, detected_at, resolved_at) rows; first resolution wins."""
    r = resolutions.groupBy("job_name", "detected_at").agg(F.min("resolved_at").alias("_r"))
    return (incidents.join(r, ["job_name", "detected_at"], "left")
            .withColumn("resolved_at", F.coalesce("resolved_at", "_r")).drop("_r"))


def publish_resolutions(spark: SparkSession, path: str, resolutions: DataFrame, number: int) -> None:
    """K3 for good: the stored incidents (``files.publish_buckets`` by job) take the resolutions of publication ``number``.

    Only buckets of resolved jobs are read and rewritten; an incident that has a resolution keeps it, and a repeated
    publication changes nothing.
    """
    if not IO.is_newer(spark, path, number):
        return
    buckets = IO.manifest(spark, path)["count"]
    own = IO.buckets_of(resolutions, "job_name", buckets)
    there = IO.read_buckets(spark, path, only=own)
    IO.publish_buckets(resolve(there, resolutions).select(there.columns), path, "job_name", buckets, number)


def incident_log(incidents: DataFrame, n: int = 20) -> DataFrame:
    """K4: the n newest incidents with an open/resolved flag."""
    return (incidents.orderBy(F.col("detected_at").desc(), F.col("job_name"))
            .limit(n)
            .select("job_name", "detected_at", "resolved_at",
                    F.when(F.col("resolved_at").isNotNull(), "resolved").otherwise("open").alias("state")))


def mttr(incidents: DataFrame, by: list[str] | None = None) -> DataFrame:
    """K5/A10: mean minutes from detection to resolution over resolved incidents."""
    r = incidents.filter(F.col("resolved_at").isNotNull())
    m = minutes_between("resolved_at", "detected_at")
    aggs = [F.count(F.lit(1)).alias("resolved"), rnd(F.avg(m), 6).alias("mttr_minutes")]
    return r.groupBy(*(by or [])).agg(*aggs)
