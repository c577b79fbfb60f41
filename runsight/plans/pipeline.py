"""The whole batch product in one call: runs in, five gold tables out.

Gold metrics are computed once and written as a table under ``out``; every
later output but volume growth (which needs the runs' order) reads that table
back, so the lineage of the downstream jobs starts at a small written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import lit_ts
from runsight.operators import deadlines as D
from runsight.operators import fingerprint as FP
from runsight.operators import graph as G
from runsight.operators import metrics as M
from runsight.operators import sla as H
from runsight.operators import verdicts as V
from runsight.sources import extract as X
from runsight.sources import files as IO
from runsight.sources import signals as S


def run(runs: DataFrame, registry: DataFrame, infra_metrics: DataFrame, ci: DataFrame, deadlines: DataFrame,
        as_of, out: str, infra_minutes: int = 30, p95: str = "exact", min_runs: int = M.MIN_RUNS,
        signals_as_of=None) -> dict[str, DataFrame]:
    """Compute and write gold_job_metrics, gold_verdicts, gold_fingerprint, gold_sla_health and
    gold_deadline_risk under ``out``, each published as a whole (``replace_atomic``); return them read back.

    ``signals_as_of``: the time at which infra and CI signals are read, as_of unless given."""
    spark = runs.sparkSession
    base = out.rstrip("/")
    IO.replace_atomic(M.job_metrics(runs, min_runs=min_runs, p95=p95, as_of=as_of), f"{base}/gold_job_metrics")
    metrics = IO.read_current(spark, f"{base}/gold_job_metrics")
    edges = G.edges(registry)
    seen = as_of if signals_as_of is None else signals_as_of
    infra = S.infra_signals(infra_metrics, seen, infra_minutes)
    outputs = {
        "gold_verdicts": V.gold_verdicts(metrics, as_of),
        "gold_fingerprint": FP.fingerprint(metrics, edges, infra, ci, seen),
        "gold_sla_health": H.sla_health(runs, metrics),
        "gold_deadline_risk": D.deadline_risk(metrics, deadlines, as_of),
    }
    for name, df in outputs.items():
        IO.replace_atomic(df, f"{base}/{name}")
    res = {"gold_job_metrics": metrics}
    res.update({name: IO.read_current(spark, f"{base}/{name}") for name in outputs})
    return res


def land_runs(task_records: DataFrame, results: DataFrame, registry: DataFrame, as_of, lookback_hours: int,
              silver: str) -> DataFrame:
    """Extract completed runs of known jobs, give each its rows_processed, add them to silver; returns the silver table.

    Of several copies of a run in one extract the longest counts (then by status and rows); a copy in a later extract that
    differs replaces the one in silver (``upsert_partitioned``, by ``landed_at`` = as_of).  Calling it again with the
    same records changes nothing.
    """
    spark = task_records.sparkSession
    runs = X.extract_runs(task_records, registry, as_of, lookback_hours)  # none without job, start or duration
    key = ["job_name", "run_id", "start_time"]
    attrs = ["team", "impact", "sla_minutes", "normal_rows"]
    # the job's attributes stay behind while runs travel to their results
    new = X.attach_rows_processed(runs.drop(*attrs), results, registry, all_known=True)
    new = (new.join(registry.select("job_name", *attrs), "job_name")
           .select(*runs.columns, *[c for c in new.columns if c not in runs.columns]))
    new = IO.newest(new, key, ["duration_minutes", "status", "rows_processed"]).withColumn("landed_at", lit_ts(as_of))
    IO.upsert_partitioned(new, silver, key, "start_time", "landed_at", never_null=["job_name"], times=runs)
    return spark.read.parquet(silver)


def end_to_end(task_records: DataFrame, results: DataFrame, registry: DataFrame, infra_metrics: DataFrame,
               ci: DataFrame, deadlines: DataFrame, as_of, lookback_hours: int, out: str,
               signals_as_of=None) -> dict[str, DataFrame]:
    """The product's own flow: task records and results to silver runs, silver runs to the five gold tables."""
    base = out.rstrip("/")
    runs = land_runs(task_records, results, registry, as_of, lookback_hours, f"{base}/silver_job_runs")
    return run(runs, registry, infra_metrics, ci, deadlines, as_of, f"{base}/gold", signals_as_of=signals_as_of)


def summary(gold: dict[str, DataFrame]) -> DataFrame:
    """Counts per verdict, read from the gold table (no recomputation)."""
    return V.verdict_counts(gold["gold_job_metrics"]).orderBy(F.col("verdict"))
