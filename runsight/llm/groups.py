"""Groups of equal keys with a heavy-hitter split.

A key may hold a third of all rows.  A Misra-Gries summary finds the frequent keys: a fixed number of
counters per task, every counter lowered when the table is full, merged over tasks.  Spark ships it as the
frequent-items sketch behind ``approx_top_k``.  Its candidates are counted exactly (map-side combined); those
that really hold at least 1 / SHARE of the rows are the winners.  There can be no more than SHARE of them, so
their table is broadcast with a proven bound and their rows never move.  All other keys are small and take an
ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runsight.llm.common import written

#: A winner holds at least this fraction (1 / SHARE) of all rows, so there are at most SHARE winners.
SHARE = 1000
#: Counters of the summary; its error is below rows / SHARE.
COUNTERS = 8192


def winners(rows: DataFrame, key: str, id_col: str, pick: Callable[[Column], Column]) -> DataFrame:
    """(key, keep_id, group_size) of the verified heavy hitters, at most SHARE rows, written.

    ``rows`` should be a written table (it is read three times).  Null keys never win.
    """
    total = rows.count()
    found = (rows.filter(F.col(key).isNotNull())
             .select(F.expr(f"approx_top_k(`{key}`, {SHARE}, {COUNTERS})").alias("top"))
             .select(F.explode("top.item").alias(key)))
    counted = (rows.join(F.broadcast(found), key)
               .groupBy(key).agg(pick(F.col(id_col)).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .filter((F.col("group_size") > 1) & (F.col("group_size") * SHARE >= F.lit(total))))
    return written(counted, "winners")


def with_groups(rows: DataFrame, key: str, id_col: str,
                pick: Callable[[Column], Column] = F.max) -> DataFrame:
    """``rows`` with keep_id (``pick`` of the ids of equal keys) and group_size.

    Rows with a null key are groups of their own.  ``rows`` must be a written table and must not have
    columns named keep_id or group_size.
    """
    won = winners(rows, key, id_col, pick)
    heavy = rows.join(F.broadcast(won), key)
    same = Window.partitionBy(key)
    light = (rows.filter(F.col(key).isNotNull()).join(F.broadcast(won.select(key)), key, "left_anti")
             .withColumns({"keep_id": pick(F.col(id_col)).over(same),
                           "group_size": F.count(F.lit(1)).over(same)}))
    alone = rows.filter(F.col(key).isNull()).withColumns(
        {"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long")})
    order = [*rows.columns, "keep_id", "group_size"]
    return light.select(order).unionByName(heavy.select(order)).unionByName(alone.select(order))
