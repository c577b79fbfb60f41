"""File sources and sinks.

Every reader takes a fixed schema (no inference); malformed records land in
``_corrupt_record`` instead of failing the job.  Sinks use Spark's file commit
protocol; the atomic replace writes a new version folder and then swaps a
pointer file with a single rename.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runsight.functions.core import lit_ts
from runsight.operators.chunked import join_same
from runsight.session import scratch_dir

RUN_SCHEMA = T.StructType([
    T.StructField("job_name", T.StringType()), T.StructField("team", T.StringType()),
    T.StructField("impact", T.StringType()), T.StructField("sla_minutes", T.DoubleType()),
    T.StructField("normal_rows", T.LongType()), T.StructField("depends_on", T.ArrayType(T.StringType())),
    T.StructField("cycle_number", T.LongType()), T.StructField("run_id", T.StringType()),
    T.StructField("start_time", T.TimestampType()), T.StructField("duration_minutes", T.DoubleType()),
    T.StructField("rows_processed", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("volume_multiplier", T.DoubleType()), T.StructField("_corrupt_record", T.StringType()),
])

# Silver columns and their types (the cleaning contract).
SILVER_TYPES = [("job_name", "string"), ("team", "string"), ("impact", "string"), ("sla_minutes", "double"),
                ("normal_rows", "bigint"), ("cycle_number", "bigint"), ("run_id", "string"),
                ("start_time", "timestamp"), ("duration_minutes", "double"), ("rows_processed", "bigint"),
                ("status", "string"), ("volume_multiplier", "double")]


def read_runs_json(spark: SparkSession, path: str, multiline: bool = True, schema: T.StructType = RUN_SCHEMA
                   ) -> DataFrame:
    """Run files holding JSON arrays (``multiline``) or one record per line."""
    return (spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def read_runs_ndjson(spark: SparkSession, path: str, schema: T.StructType = RUN_SCHEMA) -> DataFrame:
    """Newline-delimited JSON."""
    return read_runs_json(spark, path, multiline=False, schema=schema)


def write_ndjson(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 10000) -> None:
    """Write records as gzip JSON-array files of at most ``rows_per_file`` records each.

    Every partition cuts its own rows into arrays, one a file: nothing is shuffled, no array grows with the table.
    """
    def arrays(batches):
        held = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= rows_per_file:
                yield _array_batch(held[:rows_per_file])
                held = held[rows_per_file:]
        if held:
            yield _array_batch(held)

    recs = df.select(F.to_json(F.struct(*df.columns)).alias("j"))
    (recs.mapInArrow(arrays, "value string").write.mode("overwrite").option("maxRecordsPerFile", 1)
     .option("compression", "gzip").text(path))


def _array_batch(records: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"value": ["[" + ",\n".join(records) + "]"]})


def clean_runs(raw: DataFrame, as_of) -> DataFrame:
    """Cast to the silver types with ``try_cast``; a value that does not cast
    becomes NULL and the row is flagged ``quarantined``.  ``processed_at`` is the
    given as_of, not the wall clock."""
    cols, bad = [], []
    for name, typ in SILVER_TYPES:
        if name not in raw.columns:
            cols.append(F.lit(None).cast(typ).alias(name))
            continue
        c = F.col(name)
        cast = c.try_cast(typ)
        cols.append(cast.alias(name))
        bad.append(c.isNotNull() & cast.isNull())
    q = F.lit(False)
    for b in bad:
        q = q | b
    if "_corrupt_record" in raw.columns:
        q = q | F.col("_corrupt_record").isNotNull()
    return raw.select(*cols, q.alias("quarantined"), lit_ts(as_of).alias("processed_at"))


def write_snapshot(df: DataFrame, path: str) -> None:
    """S3: full overwrite (empty frames are written too, so stale rows never survive)."""
    df.write.mode("overwrite").parquet(path)


def append_partitioned(df: DataFrame, path: str, as_of=None, ts_col: str | None = None) -> None:
    """Append under year=/month=/day= folders.

    With ``as_of`` the whole batch lands in the folder of its processing date
    (one folder per append, as the reference does); with ``ts_col`` rows are
    filed by their own event date, clustered by the partition columns first (a
    large day is split over several tasks and files).
    """
    if (as_of is None) == (ts_col is None):
        raise ValueError("give exactly one of as_of or ts_col")
    d = F.to_date(lit_ts(as_of)) if as_of is not None else F.to_date(ts_col)
    out = df.withColumn("_day", d)
    if ts_col is not None:
        out = out.hint("rebalance", "_day")
    out = out.withColumns({"year": F.year("_day"), "month": F.month("_day"), "day": F.dayofmonth("_day")}).drop("_day")
    out.write.mode("append").option("compression", "zstd").partitionBy("year", "month", "day").parquet(path)


def newest(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row a key: the copy that is greatest in ``order`` (U4: latest wins)."""
    rest = [c for c in df.columns if c not in key]
    return (df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
            .select(*key, "_r.*").select(df.columns))


@contextmanager
def clustering_kept(spark: SparkSession):
    """Joins started inside take a side as it is that is clustered by some of their columns, and shuffle the other to it."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def upsert_partitioned(new: DataFrame, path: str, key: list[str], ts_col: str, stamp: str,
                       never_null: list[str] | None = None, times: DataFrame | None = None) -> None:
    """S4 with corrections: rows whose key the table lacks are appended; a copy that differs and was not extracted before
    (``stamp``) replaces the one there; anything else is left out, so a replay changes nothing.

    ``new`` has one row a key.  Only the months of ``new`` are read (a static filter on the partition columns), and only
    the days with corrected rows are rewritten, by dynamic partition overwrite.  Rows are filed by the date of
    ``ts_col``, which must be a part of the key: a correction stays in its day.

    Of known rows the key, the stamp and 64 bits of the other values travel.  ``never_null``: key columns that hold no NULL in
    ``new``; if it is clustered by them, only the known rows are shuffled.  ``times``: a table that is cheaper to read
    than ``new`` and holds all its values of ``ts_col`` (or more).
    """
    spark = new.sparkSession
    if not exists(spark, path):
        return append_partitioned(new, path, ts_col=ts_col)
    months = [r[0] for r in (new if times is None else times).select(F.date_format(ts_col, "yyyyMM").cast("int")).distinct().collect()]
    there = spark.read.parquet(path)
    month = F.col("year") * 100 + F.col("month")
    there = there.filter(month.isin([m for m in months if m is not None])
                         | (F.col("year").isNull() if None in months else F.lit(False)))
    rest = [c for c in new.columns if c not in key and c != stamp]
    copy = F.xxhash64(*rest, *[F.col(c).isNull() for c in rest])
    plain = never_null or []
    seen = there.select(*[F.col(c).alias(f"_on_{c}") for c in key], copy.alias("_old"), F.col(stamp).alias("_seen"),
                        F.lit(True).alias("_there"))
    same = [F.col(c) == F.col(f"_on_{c}") if c in plain else F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in key]
    state = new.join(seen, same, "left").filter(
        F.col("_there").isNull() | ((F.col("_seen") < F.col(stamp)) & (copy != F.col("_old"))))
    state = state.withColumn("_corrects", F.col("_there").isNotNull()).select(*new.columns, "_corrects")
    tmp = scratch_dir(spark, "landing")
    with clustering_kept(spark):
        state.write.option("compression", "zstd").parquet(tmp)
    state = spark.read.schema(state.schema).parquet(tmp)
    fixed = state.filter("_corrects").drop("_corrects")
    days = [r[0] for r in fixed.select(F.to_date(ts_col)).distinct().collect()]
    if days:
        own = there.filter(F.make_date("year", "month", "day").isin(days)).select(new.columns)
        whole = join_same(own, fixed.select(key), key, "left_anti").unionByName(fixed)
        tmp = scratch_dir(spark, "rewritten")
        whole.write.parquet(tmp)  # the days are read and written: not in one step
        d = F.to_date(ts_col)
        (spark.read.schema(whole.schema).parquet(tmp)
         .withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}).hint("rebalance", "year", "month", "day")
         .write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month", "day").parquet(path))
    append_partitioned(state.filter(~F.col("_corrects")).drop("_corrects"), path, ts_col=ts_col)


def read_recent(spark: SparkSession, path: str, as_of, days: int) -> DataFrame:
    """Rows of the last ``days`` days up to as_of; the predicate uses only partition
    columns, so whole folders are pruned before any file is opened."""
    df = spark.read.parquet(path)
    pdate = F.make_date("year", "month", "day")
    lo = F.date_sub(F.to_date(lit_ts(as_of)), days)
    return df.filter((pdate >= lo) & (pdate <= F.to_date(lit_ts(as_of))))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


#: Replaced versions are kept this long for readers that still use them.
KEEP_HOURS = 24.0


def drop_versions(spark: SparkSession, path: str, keep_hours: float, used: set[str] | None = None) -> None:
    """Remove versions older than ``keep_hours``, never the one that the pointer names (or those in ``used``)."""
    fs, p, jvm = _fs(spark, path)
    current = {_current_version(spark, path)} if used is None else used
    now = jvm.java.lang.System.currentTimeMillis()
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v-") and name not in current and now - st.getModificationTime() >= keep_hours * 3_600_000:
            fs.delete(st.getPath(), True)


def _point(spark: SparkSession, path: str, version: str, line: str) -> None:
    """Make ``line`` the content of the ``_CURRENT`` pointer in one step."""
    fs, _, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_CURRENT.{version}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(line.encode()))
    out.close()
    cur = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_CURRENT")
    # FileContext.rename with OVERWRITE replaces the pointer in one step.
    fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(cur.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    opts = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    opts[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    fc.rename(tmp, cur, opts)


def replace_atomic(df: DataFrame, path: str, keep_hours: float = KEEP_HOURS) -> str:
    """Write a new version folder, then swap the ``_CURRENT`` pointer by rename.

    Readers that resolved the old pointer keep reading the old version, until it is ``keep_hours`` old and a later
    publication removes it; a failed write leaves the pointer untouched.  Returns the version folder.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(f"{path.rstrip('/')}/{version}")
    _point(spark, path, version, version)
    drop_versions(spark, path, keep_hours)
    return version


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def _current_version(spark: SparkSession, path: str) -> str:
    fs, _, jvm = _fs(spark, path)
    cur = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_CURRENT")
    stream = fs.open(cur)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream))
    version = reader.readLine().strip()
    reader.close()
    return version


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the version that the ``_CURRENT`` pointer names."""
    return f"{path.rstrip('/')}/{_current_version(spark, path)}"


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """Read the version the ``_CURRENT`` pointer names."""
    return spark.read.parquet(current_folder(spark, path))


# ---- tables by key bucket: a publication rewrites the buckets it touches ------
def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def buckets_of(df: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that the rows of ``df`` fall in (at most ``buckets``)."""
    return sorted(r[0] for r in df.select(bucket_of(key, buckets)).distinct().collect())


def manifest(spark: SparkSession, path: str) -> dict:
    """What the pointer of a bucketed table says: its last publication's number, bucket count, schema and each bucket's version."""
    if not exists(spark, f"{path.rstrip('/')}/_CURRENT"):
        return {"number": None, "count": None, "schema": None, "versions": {}}
    return json.loads(_current_version(spark, path))


def is_newer(spark: SparkSession, path: str, number: int) -> bool:
    """Whether publication ``number`` is still to be made."""
    last = manifest(spark, path)["number"]
    return last is None or number > last


def read_buckets(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 only: list[int] | None = None) -> DataFrame:
    """A bucketed table, or the files of some buckets; without a publication an empty table of ``schema``."""
    m = manifest(spark, path)
    own = m["versions"] if only is None else {b: v for b, v in m["versions"].items() if int(b) in set(only)}
    kept = T.StructType.fromJson(m["schema"]) if m["schema"] else schema
    if kept is None:
        raise FileNotFoundError(f"no publication under {path}")
    if not own:
        return spark.createDataFrame([], kept)
    return spark.read.schema(kept).parquet(*[f"{path.rstrip('/')}/{v}/bucket={b}" for b, v in sorted(own.items())])


def publish_buckets(df: DataFrame, path: str, key: str, buckets: int, number: int,
                    keep_hours: float = KEEP_HOURS) -> list[int]:
    """Copy on write: ``df`` has all rows of each bucket it touches; they replace those buckets in one step.

    The other buckets stay in the version that wrote them.  The pointer holds the number of the publication (rising;
    see ``is_newer``).  Versions that no bucket uses any more go when they are ``keep_hours`` old.  Returns the
    buckets written.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    m = manifest(spark, path)
    if m["count"] not in (None, buckets):
        raise ValueError(f"{path} has {m['count']} buckets, not {buckets}")
    version = f"v-{uuid.uuid4().hex}"
    (df.withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", "bucket").write.mode("error")
     .partitionBy("bucket").parquet(f"{base}/{version}"))
    fs, _, jvm = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{base}/{version}"))]
    done = sorted(int(n.split("=")[1]) for n in names if n.startswith("bucket="))
    versions = {**m["versions"], **{str(b): version for b in done}}
    line = json.dumps({"number": number, "count": buckets, "schema": df.schema.jsonValue(), "versions": versions})
    _point(spark, path, version, line)
    drop_versions(spark, path, keep_hours, set(versions.values()))
    return done


def write_incidents(df: DataFrame, path: str) -> None:
    """Append incidents partitioned by detection date."""
    df.withColumn("detected_date", F.to_date("detected_at")).write.mode("append") \
        .partitionBy("detected_date").parquet(path)
