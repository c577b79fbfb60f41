"""Incremental baselines: partials of a batch of runs merge into one kept row a job.

A refresh reads the new runs only.  A partial holds counts, means and squared deviations, the failures, the latest run
and a KLL sketch of the durations; ``fold`` merges partials into partials, so the kept state is one row a job however long
its history is.  State and gold are stored by key bucket (``files.publish_buckets``): a refresh rewrites the
buckets of its own jobs and commits them with its number, so a repeated refresh changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runsight.operators import metrics as M
from runsight.session import scratch_dir
from runsight.sources import files as IO
from runsight.streaming.runs import run_available

#: Size of the sketch, and the rank error of its p95 that the queries and tests hold it to.
KLL_K, RANK_ERROR = 800, 0.01
BUCKETS = 64
_PARTS = {"d": "duration_minutes", "r": "rows_processed"}
_LATEST = ("team", "impact", "sla_minutes", "duration_minutes", "rows_processed", "status", "start_time", "run_id")


def partials(runs: DataFrame, k: int = KLL_K) -> DataFrame:
    """One mergeable row a job of ``runs`` (jobs without a name are left out); one shuffle, partial on the map side."""
    aggs = [F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "failed").alias("failed")]
    for p, name in _PARTS.items():
        v = F.col(name).cast("double")
        n = F.count(v)
        aggs += [n.alias(f"n_{p}"), F.coalesce(F.avg(v), F.lit(0.0)).alias(f"mean_{p}"),
                 F.coalesce(F.var_pop(v) * n, F.lit(0.0)).alias(f"m2_{p}")]
    sketch = F.kll_sketch_agg_double(F.col("duration_minutes").cast("double"), k)
    latest = F.max_by(F.struct(*_LATEST), F.struct(*M.RUN_ORDER))
    return (runs.filter(F.col("job_name").isNotNull()).groupBy("job_name")
            .agg(*aggs, sketch.alias("sketch"), latest.alias("latest")))


def fold(parts: DataFrame, k: int = KLL_K) -> DataFrame:
    """Partials merged to one row a job; squared deviations are taken about the merged mean, so nothing cancels."""
    w = Window.partitionBy("job_name")
    centre, aggs = {}, [F.sum("runs").alias("runs"), F.sum("failed").alias("failed")]
    for p in _PARTS:
        n, mean = F.col(f"n_{p}"), F.col(f"mean_{p}")
        centre[f"_c_{p}"] = F.coalesce(F.try_divide(F.sum(n * mean).over(w), F.sum(n).over(w)), F.lit(0.0))
        off = mean - F.col(f"_c_{p}")
        aggs += [F.sum(n).alias(f"n_{p}"), F.max(f"_c_{p}").alias(f"mean_{p}"),
                 F.sum(F.col(f"m2_{p}") + n * off * off).alias(f"m2_{p}")]
    order = F.struct(*[F.col("latest")[c] for c in M.RUN_ORDER])
    return (parts.withColumns(centre).groupBy("job_name")
            .agg(*aggs, F.kll_merge_agg_double("sketch", k).alias("sketch"), F.max_by("latest", order).alias("latest")))


def _buffers(state: DataFrame) -> DataFrame:
    """The aggregate buffers that ``metrics.finalize_metrics`` reads."""
    def mean(p: str) -> Column:
        return F.when(F.col(f"n_{p}") > 0, F.col(f"mean_{p}"))

    def sd(p: str) -> Column:
        return F.when(F.col(f"n_{p}") > 1, F.sqrt(F.col(f"m2_{p}") / (F.col(f"n_{p}") - 1)))

    p95 = F.when(F.col("n_d") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.95)))
    return state.select("job_name", F.col("runs").alias("total_runs"), F.col("n_d").alias("duration_runs"),
                        mean("d").alias("_avg_d"), sd("d").alias("_sd_d"), p95.alias("_p95"), mean("r").alias("_avg_r"),
                        sd("r").alias("_sd_r"), (F.col("failed") / F.col("runs")).alias("_fail"),
                        F.col("latest").alias("_l"))


def metrics_of(state: DataFrame, min_runs: int = M.MIN_RUNS) -> DataFrame:
    """Gold metrics of a state table; p95 is the sketch's, a duration that occurred within ``RANK_ERROR`` of rank 0.95."""
    return M.finalize_metrics(_buffers(state), min_runs=min_runs)


def refresh(runs: DataFrame, state_path: str, gold_path: str, number: int, min_runs: int = M.MIN_RUNS,
            buckets: int = BUCKETS, k: int = KLL_K) -> None:
    """Merge the new ``runs`` of refresh ``number`` (rising) into the state, then publish their jobs' gold rows.

    Each of the two tables holds the number of its last refresh: a refresh that the state has is not merged again,
    one that gold has is not published again.  An empty batch changes no row.
    """
    spark = runs.sparkSession
    tmp = scratch_dir(spark, "partials")
    partials(runs, k).write.parquet(tmp)
    new = spark.read.parquet(tmp)
    own = IO.buckets_of(new, "job_name", buckets)
    if IO.is_newer(spark, state_path, number):
        both = IO.read_buckets(spark, state_path, new.schema, own).unionByName(new)
        IO.publish_buckets(fold(both, k), state_path, "job_name", buckets, number)
    if IO.is_newer(spark, gold_path, number):
        state = IO.read_buckets(spark, state_path, new.schema, own)
        IO.publish_buckets(metrics_of(state, min_runs), gold_path, "job_name", buckets, number)


def gold(spark: SparkSession, gold_path: str) -> DataFrame:
    """The whole gold table as last published."""
    return IO.read_buckets(spark, gold_path)


def stream_refresh(runs: DataFrame, state_path: str, gold_path: str, checkpoint: str, min_runs: int = M.MIN_RUNS,
                   buckets: int = BUCKETS) -> None:
    """Each micro-batch is one ``refresh`` with its batch id; the stream itself keeps no state."""
    def per_batch(df: DataFrame, batch_id: int) -> None:
        refresh(df, state_path, gold_path, batch_id, min_runs, buckets)

    run_available(runs.writeStream.foreachBatch(per_batch), checkpoint)
