"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the words of all
documents; a target stops at REPEAT times its source's size and the excess is shared again by weight.

Schedule: the mixture has a slot for about every BLOCK words, so slots grow with the corpus.  Slot i has the
golden-ratio point u_i = i * 1327217885 mod 2^31, whose place in the cumulated targets names its source; slots are
ranked within their source.  A source that no point meets has one slot, at the place of its targets.  A source's words
are those of its documents in a shuffled order (MD5 of doc_id), repeated at most REPEAT times and cut at the target;
they are dealt to its slots in equal blocks (of sizes that differ by one word at most).  Slot with rank r of a source
takes its block r, so each source comes to its target exactly, be it large or small.

All arithmetic is on integers, so reruns agree.  Ranks and offsets are prefix sums over small (source, chunk)
tables; no window holds a whole source.  Unpartitioned windows exist over the table of sources only.

Defined results: a document without words has size 0 and taken 0; a null doc_id is ordered as the text
"null"; repeated rows are mixed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsight.llm.common import free_name, words_of, written

WEIGHTS = (5, 2, 1)
REPEAT = 3
BLOCK = 64
GOLDEN, RING = 1327217885, 1 << 31
CELLS = 4096
CHUNK = 1 << 14


def sizes(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc_id, source, size, place) of each document; place gives the shuffled order.  Written."""
    return written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.size(words_of(F.col(text))).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).alias("place")), "sizes")


def targets(sized: DataFrame, weights=WEIGHTS, repeat: int = REPEAT) -> DataFrame:
    """(source, weight, source_size, target, lo, hi): targets in words and the source's part of [0, 2^31).

    Filling sources in the order of size / weight, a source is full if its cap is at most its share of what
    the sources before it left; the others share the rest by weight.  One row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    n = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (n % len(weights) + 1).cast("int"))
    per = per.withColumns({"weight": weight, "total": F.sum("source_size").over(everything)})
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    cap = F.col("source_size") * repeat
    per = per.withColumns({"cap_before": F.coalesce(F.sum(cap).over(before), F.lit(0)),
                           "weight_rest": F.sum("weight").over(rest)})
    per = per.withColumn("full", cap * F.col("weight_rest") <= (F.col("total") - F.col("cap_before")) * F.col("weight"))
    left = F.coalesce(F.sum(F.when(F.col("full"), cap)).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    per = per.withColumns({"left": F.col("total") - left, "open_weight": open_weight})
    per = per.withColumn("target", F.when(F.col("full"), cap.cast("double"))
                         .otherwise(F.col("left") * F.col("weight") / F.col("open_weight")))
    width = F.when(F.col("total") > 0, F.round(F.col("target") / F.col("total") * F.lit(float(RING)))).otherwise(0)
    per = per.withColumn("width", width.cast("long"))
    hi = F.sum("width").over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    return (per.withColumn("hi", F.least(hi, F.lit(RING)))
            .withColumn("lo", F.least(hi - F.col("width"), F.lit(RING)))
            .select("source", "weight", "source_size", "target", "lo", "hi"))


def schedule(shares: DataFrame, n_slots: int) -> DataFrame:
    """(slot, skey, rank): each slot's source by its golden-ratio point, and its rank within the source."""
    spark = shares.sparkSession
    cell = RING // CELLS
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    parts = (shares.filter(F.col("hi") > F.col("lo"))
             .select(key.alias("skey"), "lo", "hi", F.explode(F.sequence(
                 F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell))).alias("cell")))
    slots = (spark.range(n_slots).select(F.col("id").alias("slot"), (F.col("id") % RING * GOLDEN % RING).alias("u"))
             .withColumn("cell", F.floor(F.col("u") / cell)))
    named = (slots.join(parts, "cell").filter((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
             .select("slot", F.floor(F.col("slot") / CHUNK).alias("chunk"), "skey"))
    count = named.groupBy("chunk", "skey").agg(F.count(F.lit(1)).alias("n"))
    start = count.select("chunk", "skey", (F.sum("n").over(Window.partitionBy("skey").orderBy("chunk")) - F.col("n"))
                         .alias("start"))
    own = F.row_number().over(Window.partitionBy("chunk", "skey").orderBy("slot")) - 1
    met = written(named.withColumn("own", own).join(start, ["chunk", "skey"])
                  .select("slot", "skey", (F.col("own") + F.col("start")).alias("rank")), "schedule")
    unmet = (shares.filter("target > 0").withColumn("skey", key).join(met.filter("rank = 0"), "skey", "left_anti")
             .select(F.floor(F.col("lo") / RING * n_slots).alias("slot"), "skey", F.lit(0).cast("long").alias("rank")))
    return met.unionByName(unmet)


def placed(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """``sized`` with source_size, target and ``at``: the words of its source before it in shuffled order."""
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    rows = sized.withColumns({"skey": key, "bin": F.substring("place", 1, 3)})
    bins = rows.groupBy("skey", "bin").agg(F.sum("size").alias("n"))
    start = bins.select("skey", "bin", (F.sum("n").over(Window.partitionBy("skey").orderBy("bin")) - F.col("n"))
                        .alias("start"))
    order = Window.partitionBy("skey", "bin").orderBy("place", "doc_id", "size")
    inside = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    return (rows.withColumn("inside", inside).join(start, ["skey", "bin"])
            .join(shares.select(key.alias("skey"), "source_size", "target"), "skey")
            .select("doc_id", "source", "skey", "size", "source_size", "target",
                    (F.col("start") + F.col("inside")).alias("at")))


def mix(sized: DataFrame, weights=WEIGHTS, repeat: int = REPEAT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The placed documents, and the mixture's pieces: (slot, doc_id, skey, at, round, words, opens).

    ``sized`` comes from ``sizes``.  A piece is the part of one document's one repetition that lies in the
    slot's block; ``opens`` marks the piece that has the document's first word.
    """
    shares = written(targets(sized, weights, repeat), "shares")
    total = shares.agg(F.sum("source_size")).first()[0] or 0
    slots = schedule(shares, -(-total // block))
    docs = written(placed(sized, shares), "placed")
    # words [0, stop) of a source over n slots: the first ``longer`` blocks have step + 1 words, the others step
    blocks = slots.groupBy("skey").agg(F.count(F.lit(1)).alias("n"))
    rows = docs.filter(F.col("size") > 0).join(blocks, "skey").withColumn("stop", F.round("target").cast("long"))
    rows = rows.withColumns({"step": F.expr("stop div n"), "longer": F.expr("stop % n")})
    begin = F.col("round") * F.col("source_size") + F.col("at")

    def rank(word: str):
        return F.expr(f"CASE WHEN {word} < longer * (step + 1) THEN ({word}) div (step + 1) "
                      f"ELSE longer + ({word} - longer * (step + 1)) div greatest(step, 1) END")

    def first(r):
        return r * F.col("step") + F.least(r, F.col("longer"))

    parts = (rows.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))
             .withColumn("begin", begin).filter(F.col("begin") < F.col("stop"))
             .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("stop")))
             .withColumn("opening", rank("begin")).withColumn("rank", F.explode(F.sequence("opening", rank("end - 1")))))
    pieces = parts.join(slots, ["skey", "rank"]).select(
        "slot", "doc_id", "skey", "source", "size", "source_size", "target", "at", "round",
        (F.least(F.col("end"), first(F.col("rank") + 1)) - F.greatest(F.col("begin"), first(F.col("rank")))).alias("words"),
        (F.col("opening") == F.col("rank")).alias("opens"))
    return docs, pieces


def taken(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes of it) for every document."""
    every, pieces = mix(sizes(docs, text, id_col, source))
    per = pieces.groupBy("skey", "at").agg(F.sum("words").alias("taken"))
    return (every.filter(F.col("size") > 0).join(per, ["skey", "at"], "left")
            .unionByName(every.filter(F.col("size") == 0).withColumn("taken", F.lit(0).cast("long")))
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def mixed_documents(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """Whole rows of ``docs``, each as often as the mix takes its first word (0 to REPEAT times).

    Documents without words stay once: they weigh nothing.  Rows with the same doc_id, source and size get
    the same number of copies, their mean rounded.
    """
    every, pieces = mix(sizes(docs, text, id_col, source))
    per = pieces.filter("opens").groupBy("skey", "at").agg(F.count(F.lit(1)).alias("copies"))
    key, place, size, n, i = free_name(docs, "mix_key", "mix_source", "mix_size", "mix_copies", "mix_copy")
    copies = (every.filter(F.col("size") > 0).join(per, ["skey", "at"], "left")
              .groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias(key), F.col("skey").alias(place),
                       F.col("size").alias(size))
              .agg(F.round(F.avg(F.coalesce("copies", F.lit(0)))).cast("int").alias(n)))
    rows = docs.withColumns({key: F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                             place: F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")),
                             size: F.size(words_of(F.col(text))).cast("long")})
    out = rows.join(copies, [key, place, size], "left")
    return (out.withColumn(n, F.when(F.col(size) == 0, F.lit(1)).otherwise(F.coalesce(F.col(n), F.lit(0))))
            .filter(F.col(n) > 0).withColumn(i, F.explode(F.sequence(F.lit(1), F.col(n)))).select(docs.columns))
