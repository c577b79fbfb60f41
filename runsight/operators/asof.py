"""As-of joins: the nearest right row before, after or on either side of each left row's time.

Both sides are cut into chunks of time: a key with more than ``target_rows`` rows by bounds from a sample of its own rows
(``chunked.bounds``), so that also a join without keys, where everything is one key, is spread; the right side is then reduced
to one row per (key, time) first.  Where no key is that large, rows are shuffled once, by key, and right rows of one time are
put in order.  Then, for each direction wanted:

1. the carry of every (key, chunk) is the nearest right row of any chunk before it (after it): an aggregate to one row
   per (key, chunk) and a running ``last(ignorenulls)`` over that small table;
2. inside a chunk, left and right rows are unioned and a running ``last(ignorenulls)`` over (key, chunk) fills
   each left row.

Both directions share the partitions (the second sorts them the other way); no pairs are formed.  Every left row is kept: one with a NULL key or
time matches nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runsight.operators.chunked import CHUNK_ROWS, bounds, chunk_of, join_same

DIRECTIONS = ("before", "after", "nearest")


def asof_join(left: DataFrame, right: DataFrame, by: str | None, left_time: str, right_time: str, values: list[str],
              direction: str = "before", target_rows: int = CHUNK_ROWS, all_known: bool = False) -> DataFrame:
    """Left rows with the ``values`` of one right row of their key (NULL if there is none).

    ``direction``: "before" takes the latest row at or before the left time, "after" the earliest at or after it,
    "nearest" the closer of the two (of equal ones the earlier).  Right rows of one key and time count as the one with the
    greatest values.  ``by=None`` joins on time alone.  ``all_known``: the caller knows that no left row has a NULL key or
    time; the result is then clustered by the key (where none is cut), so steps by that key need no shuffle.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    lcols = left.columns
    key = F.lit(0) if by is None else F.col(by)
    lt, rt = F.unix_micros(F.col(left_time)), F.unix_micros(F.col(right_time))
    # the key and a time that travel as _k and _t anyway do not travel twice
    own = {} if by is None else {by: F.col("_k")}
    if left.schema[left_time].dataType == T.TimestampType():
        own[left_time] = F.timestamp_micros("_t")
    kept = [c for c in lcols if c not in own]
    L0 = left.select(F.struct(F.lit(1).alias("_"), *kept).alias("_l"), key.alias("_k"), lt.alias("_t"))
    known = F.col("_k").isNotNull() & F.col("_t").isNotNull()
    # left rows of one instant may lie in several chunks, its right row (_tie -1) in the first of them
    L = L0.filter(known).withColumn("_tie", F.shiftrightunsigned(F.xxhash64("_l"), 1))
    R = (right.select(key.alias("_k"), rt.alias("_t"), F.struct(rt.alias("t"), F.struct(*values).alias("v")).alias("_v"))
         .filter(known).withColumn("_tie", F.lit(-1).cast("long")))

    def united(R):
        return (L.withColumn("_v", F.lit(None).cast(R.schema["_v"].dataType)).withColumn("_side", F.lit(1))
                .unionByName(R.withColumn("_side", F.lit(0)), allowMissingColumns=True))

    cuts = bounds(united(R).select("_k", "_t", "_tie"), "_k", ["_t", "_tie"], target_rows)
    if cuts is None:
        both, part = united(R), ["_k"]
    else:
        R = R.groupBy("_k", "_t", "_tie").agg(F.max("_v").alias("_v"))
        both, part = (join_same(united(R), cuts, ["_k"], "left")
                      .withColumn("_c", chunk_of(F.struct("_t", "_tie"), F.col("_blocks"))).drop("_blocks")), ["_k", "_c"]
    inside = Window.partitionBy(*part).orderBy("_t", "_side", "_v")
    out = both.withColumn("_b", F.last("_v", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    if direction != "before":
        # a frame that runs on to the end would be walked anew for each row: the order is turned round instead
        back = Window.partitionBy(*part).orderBy(F.col("_t").desc(), F.col("_side"), F.col("_v"))
        out = out.withColumn("_a", F.last("_v", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.filter(F.col("_side") == 1)
    if cuts is not None:
        per = both.groupBy("_k", "_c").agg(F.max("_v").alias("_hi"), F.min("_v").alias("_lo"))
        earlier = Window.partitionBy("_k").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
        later = Window.partitionBy("_k").orderBy(F.col("_c").desc()).rowsBetween(Window.unboundedPreceding, -1)
        per = per.select("_k", "_c",
                         F.last("_hi", ignorenulls=True).over(earlier).alias("_cb"),
                         F.last("_lo", ignorenulls=True).over(later).alias("_ca"))
        out = join_same(out, per, ["_k", "_c"], "left").withColumn("_b", F.coalesce("_b", "_cb"))
        if direction != "before":
            out = out.withColumn("_a", F.coalesce("_a", "_ca"))
    if direction == "before":
        pick = F.col("_b")
    else:
        same = F.col("_b.t") == F.col("_t")  # found going back, maybe in an earlier chunk
        after = F.when(same, F.col("_b")).otherwise(F.col("_a"))
        pick = after if direction == "after" else (
            F.when(F.col("_b").isNull(), after).when(after.isNull(), F.col("_b"))
            .when(after["t"] - F.col("_t") < F.col("_t") - F.col("_b.t"), after).otherwise(F.col("_b")))
    found = out.select(*[own.get(c, F.col("_l")[c]).alias(c) for c in lcols], *[pick["v"][c].alias(c) for c in values])
    if all_known:
        return found
    rest = left.filter(~(key.isNotNull() & lt.isNotNull())).select(
        *lcols, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in values])
    return found.unionByName(rest)
