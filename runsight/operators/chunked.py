"""Ordered per-key computations as a prefix scan, so that hot keys spread over many tasks.

A window ``partitionBy(key).orderBy(time)`` sorts all rows of one key in one task: a job or account holding a
third of all rows would become one task.  Here a key with more than ``target_rows`` rows is cut by bounds taken from a
sorted sample of its own rows, about every ``target_rows`` rows.  Bounds compare the whole order (time, then ties),
so a burst is cut as finely as an even history, rows of one instant are cut as well, and the number of chunks follows the key's
size.  Rows are windowed per (key, chunk); one carry row a chunk holds what earlier chunks contribute.

Keys are counted first: rows of each part of the keys' hashes, then the keys of parts above the target.  Where no key is hot, which is the rule, there is one chunk a key and nothing else is done.  NULL times come first; NULL keys are a key of their own.  Rows that agree in the whole order stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from runsight.session import scratch_dir

CHUNK_ROWS = 2_000_000
#: Sampled rows for each chunk: the largest of thousands of chunks then stays below twice the target.
SAMPLES = 64
#: Parts of the keys' hashes whose rows are counted before the keys themselves.
KEY_PARTS = 1 << 14


def join_same(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where NULL equals NULL; the columns are kept once."""
    named = right.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in right.columns])
    cond = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return left.join(named, cond, how).drop(*[f"_on_{c}" for c in on])


def _written(df: DataFrame, tag: str) -> tuple[DataFrame, int]:
    """``df`` written once to the shared checkpoint folder, and its number of rows."""
    path, seen = scratch_dir(df.sparkSession, tag), Observation(tag)
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["n"]


def bounds(rows: DataFrame, key: str, order: list[str], target_rows: int = CHUNK_ROWS) -> DataFrame | None:
    """(key, _blocks): the sorted bounds of the keys with more than ``target_rows`` rows; None if there is no such key.

    The bounds are every SAMPLES-th row of a sorted sample, kept as blocks of about the square root of their number, so
    that a row finds its chunk in two short passes.  They are written, so every reader sees the same ones.
    """
    # rows by hash of the key first: a count of bounded size, whatever the number of keys, and mostly no part is large
    part = F.pmod(F.xxhash64(key), F.lit(KEY_PARTS))
    large = rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_pn")).filter(F.col("_pn") > target_rows)
    large = [r["_p"] for r in large.collect()]
    if not large:
        return None
    rows = rows.filter(part.isin(large))
    sizes, hot = _written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_kn")).filter(F.col("_kn") > target_rows), "hot-keys")
    if not hot:
        return None
    share = min(1.0, SAMPLES / target_rows)
    step = max(1, round(target_rows * share))
    some = join_same(rows.select(key, F.struct(*order).alias("_at")).filter(F.rand(7) < share), sizes.select(key), [key])
    ranked = some.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy("_at")))
    cuts = (ranked.filter(F.col("_i") % step == 0).groupBy(key)
            .agg(F.array_sort(F.collect_set("_at")).alias("_cuts")))
    width = F.ceil(F.sqrt(F.size("_cuts"))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / width).cast("int")),
                         lambda i: F.slice("_cuts", i * width + 1, width))
    return _written(cuts.select(key, blocks.alias("_blocks")), "bounds")[0]


def chunk_of(at: Column, blocks: Column) -> Column:
    """How many of the key's bounds are at or before ``at``; 0 without bounds."""
    coarse = F.size(F.filter(blocks, lambda b: b[0] <= at))
    width = F.size(blocks[0])
    fine = F.size(F.filter(F.get(blocks, coarse - 1), lambda c: c <= at))
    return F.when(blocks.isNull() | (coarse == 0), 0).otherwise((coarse - 1) * width + fine)


def with_chunks(df: DataFrame, key: str, order: list[str], target_rows: int = CHUNK_ROWS) -> tuple[DataFrame, bool]:
    """(``df`` with ``_c``, the row's chunk in the order within its key; whether any key has more than one chunk)."""
    cuts = bounds(df, key, order, target_rows)
    if cuts is None:
        return df.withColumn("_c", F.lit(0)), False
    return (join_same(df, cuts, [key], "left").withColumn("_c", chunk_of(F.struct(*order), F.col("_blocks")))
            .drop("_blocks"), True)


def positions(df: DataFrame, key: str, order: list[str], target_rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds ``pos`` (1-based rank in the key's order) and ``n`` (rows of the key)."""
    d, split = with_chunks(df, key, order, target_rows)
    local = d.withColumn("_lpos", F.row_number().over(Window.partitionBy(key, "_c").orderBy(*order)))
    if not split:
        return (local.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(key, "_c")))
                .withColumnRenamed("_lpos", "pos").drop("_c"))
    # totals come from the windowed frame: both branches share its exchange
    sizes = local.groupBy(key, "_c").agg(F.count(F.lit(1)).alias("_cn"))
    before = Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select(key, "_c", F.coalesce(F.sum("_cn").over(before), F.lit(0)).alias("_off"),
                        F.sum("_cn").over(Window.partitionBy(key)).alias("n"))
    return (join_same(local, offs, [key, "_c"])
            .withColumn("pos", F.col("_lpos") + F.col("_off")).drop("_c", "_lpos", "_off"))


def prior_stats(df: DataFrame, key: str, order: list[str], values: dict[str, str],
                target_rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds count, mean and sample stddev of each value over the key's rows strictly before each row.

    ``values`` maps a prefix to a column; output columns: {prefix}_n, {prefix}_mean, {prefix}_sd.  In-chunk running
    (n, mean, M2) come from one window over (key, chunk); the earlier chunks' totals are summed on the small
    chunk table around a per-key shift (the first chunk's mean) to avoid cancellation, then merged with Chan's formula.
    """
    d, split = with_chunks(df, key, order, target_rows)
    d = d.withColumns({f"{p}_v": F.col(v).cast("double") for p, v in values.items()})
    w_in = Window.partitionBy(key, "_c").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    if not split:
        stats = {}
        for p in values:
            stats |= {f"{p}_n": F.count(f"{p}_v").over(w_in), f"{p}_mean": F.avg(f"{p}_v").over(w_in),
                      f"{p}_sd": F.stddev_samp(f"{p}_v").over(w_in)}
        return d.withColumns(stats).drop("_c", *[f"{p}_v" for p in values])
    run, tot, pre, merged = {}, [], [], {}
    wk = Window.partitionBy(key).orderBy("_c")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    whole = wk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for p in values:
        v = f"{p}_v"
        run |= {f"{p}_ln": F.count(v).over(w_in), f"{p}_lm": F.avg(v).over(w_in), f"{p}_lv": F.var_pop(v).over(w_in)}
        tot += [F.count(v).alias(f"{p}_cn"), F.avg(v).alias(f"{p}_cm"),
                (F.coalesce(F.var_pop(v), F.lit(0.0)) * F.count(v)).alias(f"{p}_cM2")]
        dev = F.coalesce(F.col(f"{p}_cm") - F.col(f"{p}_k"), F.lit(0.0))
        n = F.col(f"{p}_cn")
        pre += [F.col(f"{p}_k"), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{p}_pn"),
                F.coalesce(F.sum(n * dev).over(before), F.lit(0.0)).alias(f"{p}_ps1"),
                F.coalesce(F.sum(F.col(f"{p}_cM2") + n * dev * dev).over(before), F.lit(0.0)).alias(f"{p}_ps2")]
        pn, ln, lm, k = (F.col(f"{p}_{x}") for x in ("pn", "ln", "lm", "k"))
        pmean = F.when(pn > 0, F.col(f"{p}_ps1") / pn)  # shifted mean of earlier chunks
        pM2 = F.when(pn > 0, F.col(f"{p}_ps2") - pn * pmean * pmean).otherwise(F.lit(0.0))
        lM2 = F.coalesce(F.col(f"{p}_lv") * ln, F.lit(0.0))
        delta = lm - k - pmean
        mean = F.when(pn == 0, lm - k).when(ln == 0, pmean).otherwise(pmean + delta * ln / (pn + ln))
        M2 = F.when(pn == 0, lM2).when(ln == 0, pM2).otherwise(pM2 + lM2 + delta * delta * pn * ln / (pn + ln))
        merged |= {f"{p}_n": pn + ln, f"{p}_mean": F.when(pn + ln > 0, mean + k),
                   f"{p}_sd": F.when(pn + ln >= 2, F.sqrt(F.greatest(M2, F.lit(0.0)) / (pn + ln - 1)))}
    local = d.withColumns(run)
    sums = local.groupBy(key, "_c").agg(*tot).withColumns(
        {f"{p}_k": F.first(f"{p}_cm", ignorenulls=True).over(whole) for p in values}).select(key, "_c", *pre)
    spare = [f"{p}_{x}" for p in values for x in ("v", "ln", "lm", "lv", "k", "pn", "ps1", "ps2")]
    return join_same(local, sums, [key, "_c"]).withColumns(merged).drop("_c", *spare)


def trailing_counts(df: DataFrame, key: str, ts: str, minutes: int, target_rows: int = CHUNK_ROWS) -> DataFrame:
    """(key, ts, trailing_count): rows of the key with time in [t - minutes, t], both ends inclusive.

    The count depends on key and time only, so rows are first folded to one weighted row per (key, time).  Where no key is
    hot, a range frame counts.  Else trailing_count = #(rows with time <= t) - #(rows with time < t - minutes): two
    ranks on the key's timeline.  Each time adds a probe at t - minutes; a rank is the running weight inside the (key, chunk)
    plus the rows of all earlier chunks.  NULL times count each other.
    """
    width = minutes * 60_000_000
    t = F.unix_micros(F.col(ts))
    every = df.groupBy(key, ts).agg(F.count(F.lit(1)).alias("_d")).withColumn("_t", t)
    dated = every.filter(F.col("_t").isNotNull())
    undated = every.filter(F.col("_t").isNull()).select(key, ts, F.col("_d").alias("trailing_count"))
    marks = dated.select(key, ts, F.explode(F.array(
        F.struct(F.col("_t").alias("x"), F.col("_d").alias("d"), F.lit(True).alias("own")),
        F.struct((F.col("_t") - width).alias("x"), F.lit(0).cast("long").alias("d"), F.lit(False).alias("own"))))
        .alias("m")).select(key, ts, "m.*")
    cuts = bounds(dated.select(key, F.col("_t").alias("x")), key, ["x"], target_rows)
    if cuts is None:
        near = Window.partitionBy(key).orderBy("_t").rangeBetween(-width, 0)
        return dated.select(key, ts, F.sum("_d").over(near).alias("trailing_count")).unionByName(undated)
    marks = (join_same(marks, cuts, [key], "left").withColumn("_c", chunk_of(F.struct("x"), F.col("_blocks")))
             .drop("_blocks"))
    w = Window.partitionBy(key, "_c").orderBy("x")
    upto = F.sum("d").over(w.rangeBetween(Window.unboundedPreceding, 0))       # weight at times <= x in the chunk
    below = F.sum("d").over(w.rangeBetween(Window.unboundedPreceding, -1))     # weight at times < x in the chunk
    local = marks.withColumn("_in", F.when(F.col("own"), upto).otherwise(F.coalesce(below, F.lit(0))))
    sizes = local.groupBy(key, "_c").agg(F.sum("d").alias("_cn"))
    earlier = Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    cum = sizes.select(key, "_c", F.coalesce(F.sum("_cn").over(earlier), F.lit(0)).alias("_off"))
    rank = F.col("_in") + F.col("_off")
    counted = (join_same(local, cum, [key, "_c"]).groupBy(key, ts)
               .agg(F.sum(F.when(F.col("own"), rank).otherwise(-rank)).alias("trailing_count")))
    return counted.unionByName(undated)
