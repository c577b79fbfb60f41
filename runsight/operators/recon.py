"""Source/destination reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import rnd

TOL_PCT = 0.1


def reconcile(src: DataFrame, dst: DataFrame, keys: list[str], tol_pct: float = TOL_PCT,
              amount: str | None = None) -> DataFrame:
    """Per key: source and destination counts (and amounts), diff, diff_pct (4 dp), status.

    Both sides are aggregated first (partial aggregation), then joined full
    outer on the keys, so keys present on one side only are reported too.  A key
    that only the destination has is a MISMATCH (its percentage stays 0: there is no base).
    """
    def side(df, p):
        aggs = [F.count(F.lit(1)).alias(f"{p}_count")]
        if amount:
            aggs.append(F.sum(amount).alias(f"{p}_amount"))
        return df.groupBy(*keys).agg(*aggs)
    j = side(src, "source").join(side(dst, "destination"), keys, "full_outer")
    s = F.coalesce("source_count", F.lit(0))
    d = F.coalesce("destination_count", F.lit(0))
    diff = F.abs(s - d)
    pct = F.when(s > 0, diff.cast("double") / s * 100.0).otherwise(F.lit(0.0))
    cols = [*keys, s.alias("source_count"), d.alias("destination_count"), diff.alias("diff"),
            rnd(pct, 4).alias("diff_pct"),
            F.when((pct > tol_pct) | ((s == 0) & (d > 0)), "MISMATCH").otherwise("RECONCILED").alias("status")]
    if amount:
        cols += [rnd(F.coalesce("source_amount", F.lit(0.0)), 2).alias("source_amount"),
                 rnd(F.coalesce("destination_amount", F.lit(0.0)), 2).alias("destination_amount")]
    return j.select(*cols)


def reconcile_summary(rec: DataFrame) -> DataFrame:
    return rec.groupBy("status").agg(F.count(F.lit(1)).alias("keys"), F.sum("diff").alias("total_diff"))
