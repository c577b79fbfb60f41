"""Small helpers shared by the operators."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runsight.session import scratch_dir

#: A word is a maximal run of characters other than space, tab, LF, VT, FF and CR.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the cluster's shared checkpoint folder and read it back.

    Cuts the lineage without block-manager state, so a lost executor costs nothing but
    the tasks it was running; every reader of the table gets the same rows.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes started inside leave no shuffle files: Spark removes each one's at its end, on all executors, instead of
    when the driver's garbage collector finds them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def words_of(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not use yet (compared without case, as Spark does)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def sliced(batches, text: int, rows: int, size: int):
    """Slices of Arrow batches of at most ``rows`` rows and ``size`` bytes in column ``text`` (a longer one alone)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = int(np.searchsorted(ends, before + size, side="right"))
            end = min(max(end, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def releasing(run):
    """``run`` over a task's batches; what Arrow no longer uses then goes back to the system, as workers live on."""
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    return whole
