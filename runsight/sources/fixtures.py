"""Driver tables -> the inputs the observability operators expect.

The driver ships TPC-H-like tables plus an ``events`` stream.  This module maps
them onto run records, a job registry, infra/CI signals, transactions and so
on (the mapping is documented in FIXTURES.md).  Everything is lazy DataFrame
code, so every fixture grows with the tables it reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runsight.functions.core import lit_ts
from runsight.session import scratch_dir

# Fixed fixture parameters (FIXTURES.md section 2).
NORMAL_ROWS = 50000
DEADLINE_AS_OF = "2001-11-04 22:45:00"
INCIDENT_AS_OF = "2001-11-05 00:00:00"
EXTRACT_LOOKBACK_HOURS = 90 * 24
DEADLINES = (("ledger_lock", 6, 30), ("branch_close", 17, 45), ("fee_posting", 22, 55), ("night_seal", 23, 40),
             ("spare_window", 12, 15))  # name, hour, minute; the last has no jobs


class Tables:
    """Lazy access to the driver parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def _ts(c):
    """Driver timestamps are naive; the session runs in UTC, so the cast keeps wall time."""
    return F.col(c).cast("timestamp")


def _plus_seconds(ts_col, secs_col):
    return F.timestamp_micros(F.unix_micros(ts_col) + secs_col * F.lit(1_000_000))


def suppliers(t: Tables) -> DataFrame:
    """One row per job: k (dense supplier key), job_name, team (region name)."""
    return (t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("job_name"),
                              F.col("s_nationkey").alias("nk"))
            .join(t.nation.select(F.col("n_nationkey").alias("nk"), F.col("n_regionkey").alias("rk")), "nk")
            .join(t.region.select(F.col("r_regionkey").alias("rk"), F.col("r_name").alias("team")), "rk")
            .select("k", "job_name", "team"))


def _kept(t: Tables, name: str, df: DataFrame) -> DataFrame:
    """``df`` written once for these tables and read back.  Catalyst multiplies the sizes of joined tables; of a written one it
    knows the size, so small ones go to the rows they are joined with and large ones meet them in a shuffle."""
    if name not in t._cache:
        path = scratch_dir(t.spark, name)
        df.write.parquet(path)
        t._cache[name] = t.spark.read.schema(df.schema).parquet(path)
    return t._cache[name]


def _impact(k):
    m = k % 3
    return F.when(m == 0, "high").when(m == 1, "medium").otherwise("low")


def _run_id():
    """Zero-padded "orderkey-line-partkey" (lpad stays in codegen; format_string does not)."""
    return F.concat(F.lpad(F.col("l_orderkey").cast("string"), 10, "0"), F.lit("-"),
                    F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit("-"),
                    F.lpad(F.col("l_partkey").cast("string"), 10, "0"))


def runs(t: Tables) -> DataFrame:
    """Run records, one per lineitem row (600 per job on average)."""
    s = _kept(t, "_suppliers", suppliers(t)).withColumnRenamed("k", "l_suppkey")
    return (t.lineitem.join(s, "l_suppkey")
            .withColumnRenamed("l_suppkey", "k")
            .select(
                F.col("job_name"), F.col("team"), _impact(F.col("k")).alias("impact"),
                (F.lit(40.0) + (F.col("k") % 12)).cast("double").alias("sla_minutes"),
                F.lit(NORMAL_ROWS).cast("long").alias("normal_rows"),
                _run_id().alias("run_id"),
                _plus_seconds(_ts("l_shipdate"), F.col("l_orderkey") % 86400).alias("start_time"),
                F.col("l_quantity").alias("duration_minutes"),
                F.floor("l_extendedprice").cast("long").alias("rows_processed"),
                F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "failed")
                 .otherwise("success").alias("status"),
                F.col("l_linenumber").alias("line_no"),
            ))


def undated_runs(r: DataFrame) -> DataFrame:
    """Runs whose line 7 has no start time."""
    return r.withColumn("start_time", F.when(F.col("line_no") != 7, F.col("start_time")))


def dirty_runs(t: Tables) -> DataFrame:
    """Runs with duration missing on line 7 (about 14 %: above the 5 % null limit)."""
    return runs(t).withColumn(
        "duration_minutes", F.when(F.col("line_no") == 7, F.lit(None).cast("double"))
        .otherwise(F.col("duration_minutes")))


def _parents(s: DataFrame) -> DataFrame:
    """Edges (child k, parent name, pos): chains of 20 with two diamonds each."""
    one = s.filter(F.col("k") % 20 != 0).select(F.col("k").alias("child"), (F.col("k") - 1).alias("pk"),
                                                   F.lit(0).alias("pos"))
    two = s.filter((F.col("k") % 20).isin(5, 11)).select(F.col("k").alias("child"), (F.col("k") - 2).alias("pk"),
                                                          F.lit(1).alias("pos"))
    names = s.select(F.col("k").alias("pk"), F.col("job_name").alias("parent"))
    return one.unionByName(two).join(names, "pk")


def registry(t: Tables, tight: bool = False) -> DataFrame:
    """Job registry: job_name, team, impact, sla_minutes, normal_rows, depends_on."""
    s = suppliers(t)
    deps = (_parents(s).groupBy("child")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "parent"))).alias("d"))
            .select(F.col("child").alias("k"), F.col("d.parent").alias("depends_on")))
    sla = (F.lit(26.0) + F.lit(2.0) * (F.col("k") % 12)) if tight else (F.lit(40.0) + (F.col("k") % 12))
    return (s.join(deps, "k", "left")
            .select("job_name", "team", _impact(F.col("k")).alias("impact"),
                    sla.cast("double").alias("sla_minutes"), F.lit(NORMAL_ROWS).cast("long").alias("normal_rows"),
                    F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on")))


def runs_tight(t: Tables) -> DataFrame:
    """Runs whose SLA comes from ``registry(tight=True)`` (spreads tightness over all bands)."""
    s = suppliers(t).select("job_name", (F.lit(26.0) + F.lit(2.0) * (F.col("k") % 12)).alias("sla_t"))
    return (runs(t).join(s, "job_name")
            .withColumn("sla_minutes", F.col("sla_t")).drop("sla_t"))


def task_instances(t: Tables) -> DataFrame:
    """Scheduler task records: dag_id, run_id, start_date, duration (s, nullable), state."""
    r = runs(t)
    return r.select(F.col("job_name").alias("dag_id"), "run_id", F.col("start_time").alias("start_date"),
                    F.when(F.col("line_no") == 7, F.lit(None).cast("double"))
                     .otherwise(F.col("duration_minutes") * 60.0).alias("duration"),
                    F.col("status").alias("state"))


def registry_known(t: Tables) -> DataFrame:
    """Registry that knows 9 of every 10 jobs (k % 10 <> 9)."""
    s = suppliers(t).filter(F.col("k") % 10 != 9).select("job_name")
    return _kept(t, "_registry_known", registry(t).join(s, "job_name", "left_semi"))


def results(t: Tables) -> DataFrame:
    """Per-job result records (as-of source): job_name, recorded_at, rows_processed.

    Reduced to one row per (job, recorded_at) by max(rows)."""
    n_jobs = t.supplier.select(F.count(F.lit(1))).scalar()
    o = t.orders.select((F.col("o_custkey") % n_jobs).alias("k"),
                        _plus_seconds(_ts("o_orderdate"), F.col("o_orderkey") % 86400).alias("recorded_at"),
                        F.floor("o_totalprice").cast("long").alias("rows_processed"))
    names = _kept(t, "_suppliers", suppliers(t)).select("k", "job_name")
    return _kept(t, "_results", o.join(names, "k").groupBy("job_name", "recorded_at")
                 .agg(F.max("rows_processed").alias("rows_processed")))


def _props_k():
    return F.get_json_object("props", "$.k").cast("long")


def infra_metrics(t: Tables) -> DataFrame:
    """Infra error counters: ts, metric ('storage_errors' | 'compute_errors'), value."""
    e = t.events.filter(F.col("event_type") == "error")
    return e.select(_ts("ts").alias("ts"),
                    F.when(_props_k() % 2 == 0, "storage_errors").otherwise("compute_errors").alias("metric"),
                    F.lit(1.0).alias("value"))


def ci_runs(t: Tables) -> DataFrame:
    """CI runs: created_at, conclusion, name."""
    e = t.events.filter(F.col("event_type") == "purchase")
    return e.select(_ts("ts").alias("created_at"),
                    F.when(_props_k() >= 50, "failure").otherwise("success").alias("conclusion"),
                    F.concat(F.lit("ci-"), F.col("event_id").cast("string")).alias("name"))


def ci_history(t: Tables) -> DataFrame:
    """CI runs over the years of the job runs, one an order: created_at, conclusion, name."""
    at = _plus_seconds(_ts("o_orderdate"), F.col("o_orderkey") * 37 % 86400)
    return t.orders.select(at.alias("created_at"),
                           F.when(F.col("o_orderpriority") == "1-URGENT", "failure").otherwise("success").alias("conclusion"),
                           F.concat(F.lit("ci-"), F.col("o_orderkey").cast("string")).alias("name"))


def busy_ci(t: Tables):
    """(CI runs, as_of): every event is a CI run, one of 97 fails; as_of is 29 minutes after a failure."""
    ts = _ts("ts")
    fails = F.col("event_id") % 97 == 5
    ci = t.events.select(ts.alias("created_at"), F.when(fails, "failure").otherwise("success").alias("conclusion"),
                         F.concat(F.lit("ci-"), F.col("event_id").cast("string")).alias("name"))
    last = t.events.filter(fails & (ts < events_max_ts(t) - F.expr("INTERVAL 1 DAY"))).select(F.max(ts)).scalar()
    return ci, last + F.make_dt_interval(mins=F.lit(29))


def events_max_ts(t: Tables):
    """Scalar subquery: newest event time."""
    return t.events.select(F.max(_ts("ts"))).scalar()


def ci_as_of(t: Tables, minutes_after_failure: int):
    """Scalar subquery: latest failed CI run plus a few minutes."""
    last_fail = ci_runs(t).filter(F.col("conclusion") == "failure").select(F.max("created_at")).scalar()
    return last_fail + F.make_dt_interval(mins=F.lit(minutes_after_failure))


def deadlines(t: Tables, kolkata: bool = False) -> DataFrame:
    """Deadlines in long form: deadline_name, hour, minute, tz, job_name, pos.

    Four invented deadlines; deadline i covers jobs k % 20 = i.  A fifth has no jobs yet (one row, NULL job).
    """
    s = suppliers(t).filter(F.col("k") % 20 < 4)
    tz = F.lit("Asia/Kolkata") if kolkata else F.lit("UTC")
    i = (F.col("k") % 20).cast("int")

    def of(field):
        return F.element_at(F.array(*[F.lit(d[field]) for d in DEADLINES[:4]]), i + 1)

    idle = DEADLINES[4]
    none = t.region.filter(F.col("r_regionkey") == 0).select(
        F.lit(idle[0]).alias("deadline_name"), F.lit(idle[1]).alias("hour"), F.lit(idle[2]).alias("minute"),
        tz.alias("tz"), F.lit(None).cast("string").alias("job_name"), F.lit(None).cast("int").alias("pos"))
    return s.select(of(0).alias("deadline_name"), of(1).alias("hour"), of(2).alias("minute"), tz.alias("tz"),
                    "job_name", (F.col("k") / 20).cast("int").alias("pos")).unionByName(none)


def incidents(t: Tables, urgent: DataFrame, as_of: str = INCIDENT_AS_OF) -> DataFrame:
    """Incident table for urgent jobs with k % 4 = 0.

    detected_at = as_of - (k + 1) min; resolved when k % 8 = 0, k % 50 min later.
    """
    s = suppliers(t).filter(F.col("k") % 4 == 0)
    det = F.timestamp_micros(F.unix_micros(lit_ts(as_of)) - (F.col("k") + 1) * F.lit(60_000_000))
    return (urgent.select("job_name", "team", "verdict").join(s.select("job_name", "k"), "job_name")
            .select("job_name", "team", "verdict", det.alias("detected_at"), "k")
            .select("job_name", "team", "verdict", "detected_at",
                    F.when(F.col("k") % 8 == 0,
                           F.timestamp_micros(F.unix_micros("detected_at") + (F.col("k") % 50) * F.lit(60_000_000)))
                     .alias("resolved_at")))


def transactions(t: Tables) -> DataFrame:
    """Transactions: account_id, txn_id, amount, ts."""
    # two events share each txn_id: a source that delivers an id twice
    return t.events.select(F.col("user_id").alias("account_id"), F.floor(F.col("event_id") / 2).alias("txn_id"),
                           F.col("value").alias("amount"), _ts("ts").alias("ts"))


def hourly_volumes(t: Tables) -> DataFrame:
    """Hourly volumes: date, hour, transaction_volume, total_value."""
    e = t.events.select(_ts("ts").alias("ts"), "value")
    return (e.groupBy(F.to_date("ts").alias("date"), F.hour("ts").alias("hour"))
            .agg(F.count(F.lit(1)).alias("transaction_volume"), F.sum("value").alias("total_value")))


def type_counts(t: Tables) -> DataFrame:
    """Counts per payment type: payment_type, transaction_count."""
    return (t.orders.groupBy(F.col("o_orderpriority").alias("payment_type"))
            .agg(F.count(F.lit(1)).alias("transaction_count")))


def reconcile_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Source = orders per month, one month missing; destination = orders that have a lineitem, per month."""
    o = t.orders.select("o_orderkey", F.date_format(_ts("o_orderdate"), "yyyy-MM").alias("period"),
                        F.col("o_totalprice").alias("amount"))
    dst = o.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    return o.filter(F.col("period") != "1996-02"), dst


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
