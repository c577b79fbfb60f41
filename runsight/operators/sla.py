"""SLA health: tightness, volume growth, recommended SLA, bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsight.functions.core import rnd
from runsight.operators.chunked import CHUNK_ROWS, positions
from runsight.operators.metrics import RUN_ORDER

# Fixed thresholds of the reference.
GROW, SHRINK = 1.1, 0.9
TIGHT, AMBER = 0.8, 0.6
SLA_HEADROOM = 1.3


def volume_growth(runs: DataFrame, order: tuple[str, ...] = RUN_ORDER, split_hot: bool = True,
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Mean rows of the first and the last 20 % of each job's runs (split = max(1, n div 5)).

    Positions come from ``chunked.positions`` (windows per (job, chunk of its own history) plus a
    small prefix of chunk counts), so a job with most of the runs is
    still sorted in many tasks; ``split_hot=False`` uses one window per job.
    Then a plain conditional aggregate.
    """
    if split_hot:
        r = positions(runs.select("job_name", "rows_processed", *order), "job_name", list(order), chunk_rows)
    else:
        w = Window.partitionBy("job_name").orderBy(*order)
        wn = Window.partitionBy("job_name")
        r = runs.select("job_name", "rows_processed", F.row_number().over(w).alias("pos"),
                        F.count(F.lit(1)).over(wn).alias("n"))
    split = F.greatest(F.lit(1), F.floor(F.col("n") / 5))
    g = r.groupBy("job_name").agg(
        F.avg(F.when(F.col("pos") <= split, F.col("rows_processed"))).alias("first_rows"),
        F.avg(F.when(F.col("pos") > F.col("n") - split, F.col("rows_processed"))).alias("last_rows"))
    growth = (F.when(F.col("last_rows") > F.col("first_rows") * GROW, "growing")
              .when(F.col("last_rows") < F.col("first_rows") * SHRINK, "shrinking").otherwise("stable"))
    return g.select("job_name", rnd("first_rows", 6).alias("first_rows"), rnd("last_rows", 6).alias("last_rows"),
                    growth.alias("volume_growth"))


def sla_health(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """H1-H3: one row per warmed job (avg_duration not NULL)."""
    warm = metrics.filter(F.col("avg_duration").isNotNull())
    g = volume_growth(runs)  # every job; the warm ones are kept by the join below
    tight = rnd(F.col("avg_duration") / F.col("sla_minutes"), 3)
    return (warm.join(g, "job_name", "left")
            .select("job_name", "team", "impact", tight.alias("tightness_score"), "volume_growth",
                    "avg_duration", "sla_minutes")
            .withColumn("recommended_sla",
                        F.when(F.col("tightness_score") > TIGHT, F.rint(F.col("sla_minutes") * SLA_HEADROOM))
                        .otherwise(F.col("sla_minutes"))))


def tightness_band(health: DataFrame) -> DataFrame:
    """H4: red above 0.8, orange above 0.6, else green; percent truncated to int."""
    t = F.col("tightness_score")
    return health.select("job_name", "tightness_score",
                         F.when(t > TIGHT, "red").when(t > AMBER, "orange").otherwise("green").alias("band"),
                         (t * 100).cast("int").alias("pct_of_sla"),
                         F.when(t > TIGHT, F.col("recommended_sla")).alias("recommend_sla"))
