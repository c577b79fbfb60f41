"""Set operations on run tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_KEY = ("job_name", "run_id")


def union_runs(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def new_runs(all_runs: DataFrame, seen: DataFrame, key: tuple[str, ...] = RUN_KEY) -> DataFrame:
    """Runs whose key is not in ``seen`` (left anti join)."""
    return all_runs.join(seen.select(*key), list(key), "left_anti")


def dedupe_runs(runs: DataFrame, key: tuple[str, ...] = RUN_KEY, newest: str | None = None) -> DataFrame:
    """One row per run key.  With ``newest`` the row with the greatest value of it wins
    (a partial-aggregating ``max_by``), otherwise any copy (``dropDuplicates``)."""
    if newest is None:
        return runs.dropDuplicates(list(key))
    others = [c for c in runs.columns if c not in key]
    best = F.max_by(F.struct(*others), F.col(newest)).alias("_r")
    return runs.groupBy(*key).agg(best).select(*key, "_r.*")
