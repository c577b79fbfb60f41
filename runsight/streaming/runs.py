"""Structured Streaming forms of the batch operators.

Streams read landed files with a fixed schema; the checkpoint replaces the
reference's in-memory "already processed" set, so a restarted query resumes
where it stopped.  ``run_available`` drives a query with
``trigger(availableNow=True)`` (process everything present, then stop); the
same builders run with a processing-time trigger in production.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from runsight.operators import metrics as M
from runsight.session import scratch_dir
from runsight.sources import files as IO


#: Rows of a landed file (a task writes one), and bytes of its row groups (several tasks read one).
LANDED_ROWS, LANDED_GROUP = 2_000_000, 16 << 20


def land(df: DataFrame, path: str, files: int = 4, order: str | None = None, most_rows: int = LANDED_ROWS) -> None:
    """Write ``df`` as about ``files`` parquet files (range-split on ``order`` when given), or as many more as keep them
    near ``most_rows`` rows."""
    files = max(files, -(-df.count() // most_rows))
    out = df.repartitionByRange(files, order) if order else df.repartition(files)
    out.write.mode("append").option("parquet.block.size", LANDED_GROUP).parquet(path)


def in_steps(df: DataFrame, path: str, col: str, cuts: list[str], run) -> None:
    """Land ``df`` one time range after the other and call ``run`` after each, as a source that grows."""
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        part = df
        if lo is not None:
            part = part.filter(F.col(col) >= F.lit(lo).cast("timestamp"))
        if hi is not None:
            part = part.filter(F.col(col) < F.lit(hi).cast("timestamp"))
        part.write.mode("append").parquet(path)
        run()


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New files under ``path`` as a stream (fixed schema, no inference)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def run_available(writer, checkpoint: str):
    """Start a stream writer with availableNow and wait until all present input is processed."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def ingest(spark: SparkSession, src: str, out: str, schema: T.StructType, checkpoint: str,
           max_files: int | None = 1) -> None:
    """Incremental ingest of new files into a parquet table (exactly once via the checkpoint)."""
    s = read_stream(spark, src, schema, max_files)
    run_available(s.writeStream.format("parquet").option("path", out), checkpoint)


def stream_metrics(runs: DataFrame, p95: str = "approx") -> DataFrame:
    """Running per-job aggregate buffers (bounded state per job).

    ``percentile_approx`` keeps a fixed-size sketch; the exact form would keep
    every distinct duration in state.
    """
    return runs.groupBy("job_name").agg(*M.metric_aggs(p95=p95))


def gold_refresh(spark: SparkSession, runs: DataFrame, gold_path: str, checkpoint: str,
                 incidents_path: str | None = None, as_of=None, min_runs: int = M.MIN_RUNS) -> None:
    """Each micro-batch turns the full state into gold metrics (published as a whole, so a reader
    sees the old or the new table) and opens incidents for urgent jobs without an open one.

    Incidents of batch b are written to ``batch_id=b`` with dynamic partition overwrite and
    compared only with earlier batches, so a replayed batch yields the same rows.
    """
    agg = stream_metrics(runs)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        gold = M.finalize_metrics(df, min_runs=min_runs)
        IO.replace_atomic(gold, gold_path)
        if incidents_path is None:
            return
        g = IO.read_current(spark, gold_path)
        urgent = g.filter(F.col("verdict").isin("breached", "at_risk")).select("job_name", "team", "verdict")
        if IO.exists(spark, incidents_path):
            seen = spark.read.parquet(incidents_path).filter(F.col("batch_id") < batch_id)
            urgent = urgent.join(seen.filter(F.col("resolved_at").isNull()).select("job_name"), "job_name",
                                 "left_anti")
        stamp = F.lit(as_of).cast("timestamp") if as_of is not None else F.lit(None).cast("timestamp")
        (urgent.select("job_name", "team", "verdict", stamp.alias("detected_at"),
                       F.lit(None).cast("timestamp").alias("resolved_at"), F.lit(batch_id).alias("batch_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
         .parquet(incidents_path))

    run_available(agg.writeStream.outputMode("complete").foreachBatch(per_batch), checkpoint)


def windowed_counts(txn: DataFrame, size: str, slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Transactions per account per tumbling (or sliding) window, with a watermark."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return (txn.withWatermark("ts", delay).groupBy(w.alias("w"), "account_id")
            .agg(F.count(F.lit(1)).alias("txn_count"))
            .select("account_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "txn_count"))


RUN_KEY = ["job_name", "run_id", "start_time"]


def append_new_runs(spark: SparkSession, runs: DataFrame, silver_path: str, checkpoint: str) -> None:
    """Append runs that the silver table does not have yet, however late they come, and newer copies of known runs.

    Of several copies of a run in a micro-batch the longest counts (then by status and rows).  A copy that equals the
    one known is left out; one that differs is appended and counts from then on (``current_runs``).  Only the months of
    the micro-batch are read: a static filter on the partition column.  Rows of batch b go to ``batch_id=b`` and are compared
    with earlier batches only, so a replayed batch writes the same rows.  No state is kept and nothing is dropped
    for its age.

    New rows are shuffled once, by month and by a cut of the key, and written where they are compared.  Of known rows only
    hashes travel: 128 bits name the key, 64 tell its copies apart.
    """
    def per_batch(df: DataFrame, batch_id: int) -> None:
        month = F.date_format("start_time", "yyyy-MM")
        months = [r[0] for r in df.select(month).distinct().collect()]
        # about four (month, cut) for each shuffle partition, so a task writes few files
        cuts = max(1, -(-4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, len(months))))
        rest = [c for c in df.columns if c not in RUN_KEY]
        named = {"_k": _hashed(RUN_KEY, 0), "_k2": _hashed(RUN_KEY, 1), "_v": _hashed(rest, 0)}
        place = {"run_month": month, "_cut": F.pmod(_hashed(RUN_KEY, 2), F.lit(cuts)).cast("int")}
        rows = df.withColumns({**place, "_batch": F.lit(batch_id)})
        if IO.exists(spark, silver_path):
            dated, undated = [m for m in months if m is not None], None in months
            seen = spark.read.parquet(silver_path).filter(
                (F.col("batch_id") < batch_id)
                & (F.col("run_month").isin(dated) | (F.col("run_month").isNull() if undated else F.lit(False))))
            seen = seen.withColumns({**place, **named}).select(
                *place, F.col("batch_id").cast("int").alias("_batch"), *named)
            rows = rows.unionByName(seen, allowMissingColumns=True)
            named = {c: F.coalesce(c, x) for c, x in named.items()}
        rows = rows.repartition(*place).withColumns(named)
        order = Window.partitionBy("_k", "_k2", *place).orderBy("_batch", "duration_minutes", "status", "rows_processed")
        known = F.last(F.when(F.col("_batch") < batch_id, F.col("_v")), ignorenulls=True)
        rows = rows.withColumns({"_later": F.lead(F.lit(True)).over(order),
                                 "_known": known.over(order.rowsBetween(Window.unboundedPreceding, 0))})
        new = rows.filter(F.col("_later").isNull() & (F.col("_batch") == batch_id) & ~F.col("_v").eqNullSafe(F.col("_known")))
        (new.select(*df.columns, "run_month", F.lit(batch_id).alias("batch_id")).write.mode("overwrite")
         .option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("run_month", "batch_id")
         .parquet(silver_path))

    run_available(runs.writeStream.foreachBatch(per_batch), checkpoint)


def _hashed(columns: list[str], seed: int):
    """64 bits of the columns' values; a NULL counts where it stands."""
    return F.xxhash64(F.lit(seed), *columns, *[F.col(c).isNull() for c in columns])


def current_runs(spark: SparkSession, silver_path: str) -> DataFrame:
    """The runs of the table that ``append_new_runs`` writes: of each run the copy that came last."""
    silver = spark.read.parquet(silver_path)
    order = Window.partitionBy(*RUN_KEY).orderBy("batch_id")
    return (silver.withColumn("_later", F.lead(F.lit(True)).over(order)).filter(F.col("_later").isNull())
            .drop("_later", "run_month", "batch_id"))


def infra_windows(metrics: DataFrame, size: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Storage and compute errors per window."""
    return (metrics.withWatermark("ts", delay).groupBy(F.window("ts", size).alias("w"))
            .agg(F.sum(F.when(F.col("metric") == "storage_errors", F.col("value")).otherwise(0.0))
                 .cast("long").alias("storage_errors"),
                 F.sum(F.when(F.col("metric") == "compute_errors", F.col("value")).otherwise(0.0))
                 .cast("long").alias("compute_errors"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "storage_errors", "compute_errors"))


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which the state API needs."""
    name, cls = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, cls)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def run_stateful(spark: SparkSession, writer, checkpoint: str):
    """``run_available`` for streams that use the state API."""
    with rocksdb(spark):
        return run_available(writer, checkpoint)


DRIFT_OUT = T.StructType([
    T.StructField("job_name", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("start_time", T.TimestampType()), T.StructField("prior_runs", T.LongType()),
    T.StructField("time_drift_score", T.DoubleType()), T.StructField("volume_drift_score", T.DoubleType())])
DRIFT_STATE = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType()),
    T.StructField("nr", T.LongType()), T.StructField("mean_r", T.DoubleType()), T.StructField("m2_r", T.DoubleType())])


def moments_before(x: np.ndarray, n: int, mean: float, m2: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and squared deviations of all values before each of ``x``, and last of all; NaN counts as missing.

    ``n``, ``mean``, ``m2`` are those of what came earlier.  Sums run over distances from the mean so far, so little cancels.
    """
    there = ~np.isnan(x)
    centre = mean if n else (x[there][0] if there.any() else 0.0)
    off = np.where(there, x - centre, 0.0)
    count = n + np.concatenate([[0], np.cumsum(there)])
    shift = np.concatenate([[0.0], np.cumsum(off)]) / np.maximum(count, 1)
    square = m2 + np.concatenate([[0.0], np.cumsum(off * off)]) - count * shift * shift
    return count, centre + shift, np.maximum(square, 0.0)


def _z(x: np.ndarray, count: np.ndarray, mean: np.ndarray, m2: np.ndarray, warm: np.ndarray) -> np.ndarray:
    """Scores to 3 places, 0 where there is no spread, NaN before warm-up."""
    sd = np.sqrt(m2[:-1] / np.maximum(count[:-1] - 1, 1))
    z = np.where(sd > 0, (x - mean[:-1]) / np.where(sd > 0, sd, 1.0), 0.0)
    return np.where(warm, np.rint(z * 1000.0) / 1000.0 + 0.0, np.nan)


class DriftScores(StatefulProcessor):
    """Per job the moments of duration and rows; each run is scored against the runs before it."""

    def __init__(self, min_runs: int):
        self.min_runs = min_runs

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.moments = handle.getValueState("moments", DRIFT_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, mean, m2, nr, mean_r, m2_r = self.moments.get() if self.moments.exists() else (0, 0.0, 0.0, 0, 0.0, 0.0)
        new = pd.concat(list(rows)).sort_values(["start_time", "run_id"], kind="mergesort")
        d = new["duration_minutes"].to_numpy(float, na_value=np.nan)
        r = new["rows_processed"].to_numpy(float, na_value=np.nan)
        one, two = moments_before(d, n, mean, m2), moments_before(r, nr, mean_r, m2_r)
        warm = one[0][:-1] >= self.min_runs
        self.moments.update((int(one[0][-1]), float(one[1][-1]), float(one[2][-1]),
                             int(two[0][-1]), float(two[1][-1]), float(two[2][-1])))
        yield pd.DataFrame({"job_name": key[0], "run_id": new["run_id"], "start_time": new["start_time"],
                            "prior_runs": one[0][:-1], "time_drift_score": _z(d, *one, warm),
                            "volume_drift_score": _z(r, *two, warm)})

    def close(self) -> None:
        pass


def run_drift(runs: DataFrame, min_runs: int = M.MIN_RUNS) -> DataFrame:
    """Score each arriving run against its job's moments (six numbers of state); start it with ``run_stateful``.

    A micro-batch's runs of one job are scored in (start_time, run_id) order, by cumulative sums; ``max_files`` of
    ``read_stream`` bounds what one job brings at once.
    """
    cols = runs.select("job_name", "run_id", "start_time", F.col("duration_minutes").cast("double"),
                       F.col("rows_processed").cast("double"))
    return cols.groupBy("job_name").transformWithStateInPandas(DriftScores(min_runs), DRIFT_OUT, "Append", "None")


TRAILING_OUT = T.StructType([T.StructField("account_id", T.LongType()), T.StructField("txn_id", T.LongType()),
                             T.StructField("t", T.LongType()), T.StructField("trailing_count", T.LongType())])
TRAILING_STATE = T.StructType([T.StructField("counted", T.LongType()), T.StructField("t", T.ArrayType(T.LongType())),
                               T.StructField("txn_id", T.ArrayType(T.LongType()))])


class TrailingCounts(StatefulProcessor):
    """Per account the transactions of the last ``width`` microseconds; counted once the watermark has passed them.

    An event-time timer wakes the account at its first uncounted transaction, and last when its newest one has
    left the window, so an account that falls silent leaves no state.  Each call of the state API is a round trip to the
    JVM, so an account's state is one value: a step reads it once and writes it once.
    """

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getValueState("recent", TRAILING_STATE)

    def _wake(self, t: int) -> None:
        self.handle.registerTimer(-(-t // 1000))

    def _kept(self) -> tuple[int, list[int], list[int | None]]:
        kept = self.recent.get()
        return (np.iinfo(np.int64).min, [], []) if kept is None else (kept[0], list(kept[1]), list(kept[2]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = [(int(t), None if pd.isna(i) else int(i)) for part in rows
               for t, i in zip(part["t"].tolist(), part["txn_id"].tolist(), strict=True) if not pd.isna(t)]
        if new:
            counted, t, ids = self._kept()
            self.recent.update((counted, t + [x for x, _ in new], ids + [i for _, i in new]))
            self._wake(min(x for x, _ in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() * 1000
        after, t, ids = self._kept()
        order = np.argsort(np.array(t, np.int64), kind="stable")
        t, ids = np.array(t, np.int64)[order], [ids[i] for i in order.tolist()]
        due = np.flatnonzero((t > after) & (t <= now))
        first = int(np.searchsorted(t, now - self.width, "left"))
        if first < len(t):
            self.recent.update((now, t[first:].tolist(), ids[first:]))
            later = int(np.searchsorted(t, now, "right"))
            self._wake(int(t[later]) if later < len(t) else int(t[-1]) + self.width + 1000)
        elif len(t):
            self.recent.clear()
        if len(due):
            yield pd.DataFrame({"account_id": key[0], "txn_id": [ids[i] for i in due.tolist()], "t": t[due],
                                "trailing_count": np.searchsorted(t, t[due], "right")
                                - np.searchsorted(t, t[due] - self.width, "left")})

    def close(self) -> None:
        pass


def trailing_counts(txn: DataFrame, minutes: int, delay: str = "10 minutes") -> DataFrame:
    """W4/X6 in a stream: (account_id, txn_id, ts, trailing_count) of each transaction, the account's transactions in
    [ts - minutes, ts], emitted once the watermark has passed ts; start it with ``run_stateful``.

    Transactions that come more than ``delay`` late are left out, and so are those without a time.
    """
    cols = (txn.withWatermark("ts", delay)
            .select(F.col("account_id").cast("long"), F.col("txn_id").cast("long"), "ts", F.unix_micros("ts").alias("t")))
    out = cols.groupBy("account_id").transformWithStateInPandas(
        TrailingCounts(minutes * 60_000_000), TRAILING_OUT, "Append", "EventTime")
    return out.select("account_id", "txn_id", F.timestamp_micros("t").alias("ts"), "trailing_count")


def scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """(data folder, checkpoint folder) for one stream run."""
    return scratch_dir(spark, name), scratch_dir(spark, name + "-ckpt")
