"""Exact per-key quantiles with bounded state (linear interpolation, like ``percentile``).

``percentile`` keeps one map entry per distinct value of a group and merges a
group's maps in one task, so a key holding a third of all rows with many
distinct values does not fit.  Here:

1. one aggregation gives n and a fixed-size sketch per key, from which two
   approximate quantiles bracket the target rank with a margin of a few times
   the sketch's rank error;
2. rows below the bracket collapse into one counted group per key; rows
   inside it are reduced to (key, value, count) with map-side combining, so
   repeated values collapse too (one pass);
3. a running sum of counts over that small band table gives exact ranks, and
   the values at ranks floor(q(n-1)) and ceil(q(n-1)) are interpolated.

A key whose bracket misses the target rank (the sketch's bound failing) is
recomputed with ``percentile`` on that key alone: the exact way handles the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sketch_cols(value, q: float = 0.95, accuracy: int = 10000) -> list:
    """Aggregate columns for step 1 (can ride along in another ``groupBy.agg``)."""
    margin = 3.0 / accuracy
    qs = [max(0.0, q - margin), min(1.0, q + margin)]
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return [F.count(v).alias("_qn"),
            F.percentile_approx(v, F.array(*[F.lit(x) for x in qs]), F.lit(accuracy)).alias("_qb")]


def bounds(sketched: DataFrame, key: str, q: float = 0.95, accuracy: int = 10000) -> DataFrame:
    """(key, _n, _lo, _hi, _r) from the sketch columns.

    A key with at most ``accuracy`` values is its own band (bounded); for larger
    keys the bracket's rank margin (3n/accuracy) exceeds the sketch's rank error
    (n/accuracy) by at least two ranks.
    """
    small = F.col("_qn") <= accuracy
    return sketched.select(key, F.col("_qn").alias("_n"),
                           F.when(small, F.lit(float("-inf"))).otherwise(F.col("_qb")[0]).alias("_lo"),
                           F.when(small, F.lit(float("inf"))).otherwise(F.col("_qb")[1]).alias("_hi"),
                           (F.lit(q) * (F.col("_qn") - 1)).alias("_r"))


def banded(df: DataFrame, key: str, value: str, bnd: DataFrame, q: float, out: str) -> DataFrame:
    """Steps 2-3 given the per-key bracket ``bnd``; returns (key, out)."""
    base = df.select(key, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    j = base.join(bnd.select(key, "_lo", "_hi"), key)
    # rows under the bracket collapse into one (key, -inf) group; rows above it are dropped
    bv = F.when(F.col("_v") < F.col("_lo"), F.lit(float("-inf"))).otherwise(F.col("_v"))
    band = (j.filter(F.col("_v") <= F.col("_hi")).groupBy(key, bv.alias("_v"))
            .agg(F.count(F.lit(1)).alias("_cnt")))
    w = Window.partitionBy(key).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (band.withColumn("_end", F.sum("_cnt").over(w))
              .withColumn("_start", F.col("_end") - F.col("_cnt")))        # ranks [_start, _end) hold _v
    lo_r, hi_r = F.floor(F.col("_r")), F.ceil(F.col("_r"))
    picked = (ranked.join(bnd.select(key, "_r"), key)
              .groupBy(key).agg(
                  F.max(F.when((F.col("_start") <= lo_r) & (lo_r < F.col("_end")), F.col("_v"))).alias("_vlo"),
                  F.max(F.when((F.col("_start") <= hi_r) & (hi_r < F.col("_end")), F.col("_v"))).alias("_vhi"),
                  F.first("_r").alias("_r")))
    frac = F.col("_r") - F.floor(F.col("_r"))
    hit = (F.col("_vlo") > F.lit(float("-inf"))) & F.col("_vhi").isNotNull()   # NULL/-inf: rank outside band
    good = picked.filter(hit).select(key, (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac).alias(out))
    # keys whose bracket missed (not expected): exact percentile on those keys only
    missed = bnd.filter(F.col("_n") > 0).select(key).join(good.select(key), key, "left_anti")
    rest = base.join(missed, key, "left_semi").groupBy(key).agg(F.percentile("_v", F.lit(q)).alias(out))
    return good.unionByName(rest)


def exact_quantile(df: DataFrame, key: str, value: str, q: float = 0.95, accuracy: int = 10000,
                   alias: str | None = None) -> DataFrame:
    """(key, alias): the exact q-quantile of ``value`` per key (NULL values ignored)."""
    sk = df.groupBy(key).agg(*sketch_cols(value, q, accuracy))
    return banded(df, key, value, bounds(sk, key, q, accuracy), q, alias or f"{value}_q")
