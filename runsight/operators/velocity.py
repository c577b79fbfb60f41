"""Transaction velocity flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsight.functions.core import rnd
from runsight.operators.chunked import join_same, trailing_counts

THRESHOLD, WINDOW_MINUTES = 10, 5


def velocity_batch(txn: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Accounts with more than ``threshold`` transactions in the batch (the reference's code path)."""
    return (txn.groupBy("account_id").agg(F.count(F.lit(1)).alias("txn_count"))
            .filter(F.col("txn_count") > threshold))


def velocity_summary(txn: DataFrame, threshold: int = THRESHOLD, window_minutes: int = WINDOW_MINUTES) -> DataFrame:
    """One row: accounts, flagged accounts, flag rate (3 dp), threshold, window.

    The flagged accounts themselves stay a distributed table (velocity_batch);
    they are not gathered into this row.
    """
    per = txn.groupBy("account_id").agg(F.count(F.lit(1)).alias("txn_count"))
    total = F.count(F.lit(1))
    flagged = F.count_if(F.col("txn_count") > threshold)
    return per.agg(total.alias("total_accounts"), flagged.alias("flagged_count"),
                   rnd(F.try_divide(flagged.cast("double"), total) * 100.0, 3).alias("flag_rate_pct"),
                   F.lit(threshold).alias("threshold"), F.lit(window_minutes).alias("window_minutes"))


def velocity_trailing(txn: DataFrame, minutes: int = WINDOW_MINUTES, threshold: int = THRESHOLD,
                      split_hot: bool = True, chunk_rows: int = 2_000_000) -> DataFrame:
    """Transactions whose account made more than ``threshold`` transactions in the
    trailing ``minutes`` (both ends inclusive).

    Default: ranks on the account's own time chunks, so a busy account is spread over many tasks
    (``chunked.trailing_counts``); rows that repeat a txn_id stay rows of their own.  ``split_hot=False`` is the
    plain range frame per account.
    """
    if split_hot:
        c = trailing_counts(txn, "account_id", "ts", minutes, chunk_rows).filter(F.col("trailing_count") > threshold)
        return join_same(txn.select("account_id", "txn_id", "ts"), c, ["account_id", "ts"])
    w = (Window.partitionBy("account_id").orderBy(F.unix_micros("ts"))
         .rangeBetween(-minutes * 60_000_000, 0))
    return (txn.select("account_id", "txn_id", "ts", F.count(F.lit(1)).over(w).alias("trailing_count"))
            .filter(F.col("trailing_count") > threshold))
