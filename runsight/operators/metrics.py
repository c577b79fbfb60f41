"""Per-job baselines, drift scores, verdicts and priority.

One ``groupBy(job_name).agg`` computes every statistic.  All aggregates are
partial-aggregatable (count/avg/stddev carry fixed-size buffers, ``max_by`` of
a struct keeps one row, ``percentile`` keeps a value->count map that is bounded
by distinct durations, ``percentile_approx`` a fixed-size sketch), so a job that
holds a third of all runs is reduced map-side before the single shuffle on
``job_name``.  No window sort is needed for "latest".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import impact_weight, lit_ts, rnd, safe_z

MIN_RUNS = 30
TIME_Z = 1.5
VOLUME_Z = -1.5

RUN_ORDER = ("start_time", "run_id")


def _order_key(order: tuple[str, ...]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def metric_aggs(order: tuple[str, ...] = RUN_ORDER, p95: str = "exact", duration_status: str | None = None,
                cycle: bool = False):
    """The aggregate columns of A1 (usable in batch and in a streaming ``groupBy``)."""
    d = F.col("duration_minutes")
    if duration_status is not None:
        d = F.when(F.col("status") == duration_status, d)
    latest = F.max_by(F.struct("team", "impact", "sla_minutes", "duration_minutes", "rows_processed",
                               "status", "start_time", "run_id", *(["cycle_number"] if cycle else [])), _order_key(order))
    if p95 in ("map", "exact"):
        # "exact" is replaced by the banded exact quantile in job_metrics; this buffer serves streams
        p = F.percentile(d, F.lit(0.95))
    elif p95 == "approx":
        p = F.percentile_approx(d, F.lit(0.95), F.lit(10000))
    elif p95 == "none":
        p = F.lit(None).cast("double")
    else:
        raise ValueError("p95 must be 'exact', 'map', 'approx' or 'none'")
    return [F.count(F.lit(1)).alias("total_runs"), F.count(d).alias("duration_runs"),
            F.avg(d).alias("_avg_d"), F.stddev_samp(d).alias("_sd_d"), p.alias("_p95"),
            F.avg("rows_processed").alias("_avg_r"), F.stddev_samp("rows_processed").alias("_sd_r"),
            F.avg(F.when(F.col("status") == "failed", 1.0).otherwise(0.0)).alias("_fail"),
            latest.alias("_l")]


def finalize_metrics(agg: DataFrame, min_runs: int = MIN_RUNS, rounding: bool = True,
                     keys: tuple[str, ...] = ("job_name",), cycle: bool = False) -> DataFrame:
    """Turn the aggregate buffers of ``metric_aggs`` into the gold metrics row."""
    keys = list(keys)
    group_attrs = "team" in keys
    warm = F.col("total_runs") >= F.lit(min_runs)
    rn = (lambda x, n: rnd(x, n)) if rounding else (lambda x, n: x)
    td = rn(safe_z(F.col("_l.duration_minutes"), "_avg_d", "_sd_d"), 3)
    vd = rn(safe_z(F.col("_l.rows_processed").cast("double"), "_avg_r", "_sd_r"), 3)
    attrs = [] if group_attrs else [F.col("_l.team").alias("team"), F.col("_l.impact").alias("impact"),
                                    F.col("_l.sla_minutes").alias("sla_minutes")]
    out = agg.select(
        *keys, *attrs, "total_runs", "duration_runs",
        rn(F.col("_l.duration_minutes"), 2).alias("latest_duration"),
        F.col("_l.rows_processed").alias("latest_rows"),
        F.col("_l.status").alias("latest_status"),
        F.col("_l.start_time").alias("latest_start_time"),
        *([F.col("_l.cycle_number").alias("latest_cycle")] if cycle else []),
        F.when(warm, rn(F.col("_avg_d"), 2)).alias("avg_duration"),
        F.when(warm, rn(F.col("_p95"), 2)).alias("p95_duration"),
        F.when(warm, rn(F.col("_sd_d"), 2)).alias("stddev_duration"),
        F.when(warm, rn(F.col("_avg_r"), 2)).alias("avg_rows"),
        F.when(warm, rn(F.col("_sd_r"), 2)).alias("stddev_rows"),
        F.when(warm, rn(F.col("_fail"), 6)).alias("failure_rate"),
        F.when(warm, td).alias("time_drift_score"),
        F.when(warm, vd).alias("volume_drift_score"))
    return with_priority(with_verdict(out), rounding=rounding)


def job_metrics(runs: DataFrame, min_runs: int = MIN_RUNS, p95: str = "exact", rounding: bool = True,
                order: tuple[str, ...] = RUN_ORDER, group_attrs: bool = False,
                duration_status: str | None = None, as_of=None) -> DataFrame:
    """Per-job baseline over run records.

    runs: job_name, team, impact, sla_minutes, start_time, run_id, duration_minutes,
    rows_processed, status; with cycle_number the output has ``latest_cycle`` too.  One output row per job.

    * ``min_runs``: below it every statistic is NULL (warm-up); 0 disables the gate.
    * ``p95``: "exact" (linear interpolation by Spark's ``percentile``: one pass, one counter per distinct
      duration of a job; extracted durations have 4 decimals, so 10,000 a minute of their range), "banded" (the
      same value with bounded state for unrounded durations, a second pass, ``quantiles.exact_quantile``), "approx"
      (``percentile_approx``, fixed-size sketch) or "none" (NULL).
    * ``rounding``: compare and report rounded values (latest 2 dp, z 3 dp).
    * ``group_attrs``: group by the job's attributes too, normal_rows among them where the runs have it (an SLA change
      splits a job).
    * ``duration_status``: restrict duration statistics to runs with this status.
    * ``as_of``: the time to stamp ``verdict_computed_at`` with (no such column without it).
    """
    out = _job_metrics(runs, min_runs, p95, rounding, order, group_attrs, duration_status)
    return out if as_of is None else out.withColumn("verdict_computed_at", lit_ts(as_of))


def managed_metrics(runs: DataFrame, as_of) -> DataFrame:
    """The managed batch job's form of A1: by job and all its attributes, no warm-up gate, unrounded values compared."""
    return job_metrics(runs, min_runs=0, p95="approx", rounding=False, group_attrs=True, as_of=as_of)


def _job_metrics(runs: DataFrame, min_runs: int, p95: str, rounding: bool, order: tuple[str, ...], group_attrs: bool,
                 duration_status: str | None) -> DataFrame:
    cycle = "cycle_number" in runs.columns
    attrs = ("team", "impact", "sla_minutes", *(["normal_rows"] if "normal_rows" in runs.columns else []))
    keys = ("job_name", *attrs) if group_attrs else ("job_name",)
    r = runs.filter(F.col("job_name").isNotNull())
    if p95 != "banded":
        agg = r.groupBy(*keys).agg(*metric_aggs(order, "map" if p95 == "exact" else p95, duration_status, cycle))
        return finalize_metrics(agg, min_runs, rounding, keys, cycle)
    # The same p95 with bounded state: the sketch rides along in the one aggregation, whose
    # (per-job, small) result is written once to the shared checkpoint folder; a second pass
    # over the runs counts only the narrow value band around each job's p95.
    from runsight.operators import quantiles as QT
    from runsight.operators.graph import _materialize
    d = F.col("duration_minutes")
    if duration_status is not None:
        d = F.when(F.col("status") == duration_status, d)
    gk = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys]) if group_attrs else F.col("job_name")
    agg = r.groupBy(*keys).agg(*metric_aggs(order, "none", duration_status, cycle), *QT.sketch_cols(d))
    agg, _ = _materialize(agg.withColumn("_gk", gk), "job-metrics", F.count(F.lit(1)).alias("n"))
    q = QT.banded(r.select(gk.alias("_gk"), d.alias("_d")), "_gk", "_d", QT.bounds(agg, "_gk"), 0.95, "_pq")
    agg = agg.join(q, "_gk", "left").withColumn("_p95", F.col("_pq")).drop("_gk", "_pq", "_qn", "_qb")
    return finalize_metrics(agg, min_runs, rounding, keys, cycle)


def with_verdict(metrics: DataFrame, time_z: float = TIME_Z, volume_z: float = VOLUME_Z) -> DataFrame:
    """safe / at_risk / breached / insufficient_data.  Warm-up outranks breach."""
    td, vd = F.col("time_drift_score"), F.col("volume_drift_score")
    v = (F.when(td.isNull(), "insufficient_data")
         .when(F.col("latest_duration") > F.col("sla_minutes"), "breached")
         .when((F.coalesce(td, F.lit(0.0)) > time_z) | (F.coalesce(vd, F.lit(0.0)) < volume_z), "at_risk")
         .otherwise("safe"))
    return metrics.withColumn("verdict", v)


def with_priority(metrics: DataFrame, rounding: bool = True) -> DataFrame:
    """priority = |z_time| x impact weight (3/2/1), 2 dp; NULL during warm-up."""
    p = F.abs(F.col("time_drift_score")) * impact_weight("impact")
    return metrics.withColumn("priority_score", rnd(p, 2) if rounding else p)


def drift_scores(metrics: DataFrame) -> DataFrame:
    """C1/C2 projection."""
    return metrics.select("job_name", "time_drift_score", "volume_drift_score")


def replay_scores(runs: DataFrame, min_runs: int = MIN_RUNS, order: tuple[str, ...] = RUN_ORDER,
                  split_hot: bool = True, chunk_rows: int = 2_000_000) -> DataFrame:
    """Score every run against the history before it.

    Default: a job with more than ``chunk_rows`` runs is cut into chunks of its history; running (n, mean, M2) per
    (job, chunk) are merged with a small per-job prefix of chunk totals (``chunked.prior_stats``), so a job with
    most of the runs is spread over many tasks.  ``split_hot=False`` is the plain
    expanding frame ``rowsBetween(unboundedPreceding, -1)`` per job.
    """
    from pyspark.sql import Window as W
    base = runs.select("job_name", *[c for c in order if c != "job_name"], "duration_minutes", "rows_processed")
    if split_hot:
        from runsight.operators.chunked import prior_stats
        s = prior_stats(base, "job_name", list(order), {"_d": "duration_minutes", "_r": "rows_processed"}, chunk_rows)
        out = s.select("job_name", "run_id", "start_time", "duration_minutes", "rows_processed",
                       F.col("_d_n").alias("prior_runs"), F.col("_d_mean").alias("_m"), F.col("_d_sd").alias("_s"),
                       F.col("_r_mean").alias("_mr"), F.col("_r_sd").alias("_sr"))
    else:
        w = W.partitionBy("job_name").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        d = F.col("duration_minutes")
        r = F.col("rows_processed").cast("double")
        out = base.select("job_name", "run_id", "start_time", "duration_minutes", "rows_processed",
                          F.count(d).over(w).alias("prior_runs"), F.avg(d).over(w).alias("_m"),
                          F.stddev_samp(d).over(w).alias("_s"),
                          F.avg(r).over(w).alias("_mr"), F.stddev_samp(r).over(w).alias("_sr"))
    warm = F.col("prior_runs") >= F.lit(min_runs)
    return out.select("job_name", "run_id", "start_time", "prior_runs",
                      F.when(warm, rnd(safe_z("duration_minutes", "_m", "_s"), 3)).alias("time_drift_score"),
                      F.when(warm, rnd(safe_z(F.col("rows_processed").cast("double"), "_mr", "_sr"), 3))
                       .alias("volume_drift_score"))
