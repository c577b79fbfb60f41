"""Domain summaries: daily totals, share of total, rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import rnd
from runsight.operators.chunked import CHUNK_ROWS, join_same, positions


def daily_summary(hourly: DataFrame) -> DataFrame:
    """Per date: total volume, total value (2 dp), peak hour (first on ties), mean hourly volume (truncated)."""
    peak = F.max_by("hour", F.struct(F.col("transaction_volume"), -F.col("hour")))
    return hourly.groupBy("date").agg(
        F.sum("transaction_volume").alias("total_volume"),
        rnd(F.sum("total_value"), 2).alias("total_value"),
        peak.alias("peak_hour"),
        F.avg("transaction_volume").cast("long").alias("avg_hourly_volume"))


def share_of_total(df: DataFrame, key: str, value: str) -> DataFrame:
    """Share of each key in the grand total, 2 dp.  The total is a scalar subquery,
    not an unpartitioned window."""
    agg = df.groupBy(key).agg(F.sum(value).alias(value))
    total = df.select(F.sum(value)).scalar()
    return agg.select(key, value, rnd(F.col(value).cast("double") / total * 100.0, 2).alias("share_pct"))


def share_ranked(shares: DataFrame, value: str, target_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rank by value (equal values share a rank, NULLs last).

    Positions come from the prefix scan (``chunked.positions``) with one key for all rows, so a long table is ranked in many
    tasks; a value's rank is its first position.
    """
    order = {"_k": F.lit(0), "_n": F.col(value).isNull(), "_o": -F.col(value)}
    placed = positions(shares.withColumns(order), "_k", ["_n", "_o"], target_rows)
    first = placed.groupBy(value).agg(F.min("pos").cast("int").alias("rank"))
    return join_same(shares, first, [value])
