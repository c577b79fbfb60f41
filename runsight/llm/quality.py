"""Quality rules as a short-circuit cascade (native: DataFrame functions only).

Each rule is a Boolean column that is true where it rejects a row.  On a bounded sample the cost (seconds a
row, above that of reading the sample) and the selectivity (share of rows rejected) of each rule are
measured; the rules then run in the order of rejection per cost in one CASE expression, which stops at the
first rule that rejects.  The order changes the work only, never the verdict.

Base measures of a text (null: no words): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; see
``measures``.  An empty table gives an empty result.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsight.llm.common import free_name, let, words_of, written

#: Bound of the sample that rules are timed on (it sets their order only).
SAMPLE_ROWS = 2000
SYMBOLS = r"[#*$%&|<>]"


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its word array and the base measures, whose names must be free in ``docs``.

    n_repeat_words counts the words that lie in a 3-word window found twice or more in the text.  Windows
    are first compared by a packed (32-bit hash, position) array, sorted as longs; only those whose hash
    repeats are compared as text, so the count is exact and the work n log n in the words of a text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    w, packed, cand, hits = free_name(docs, "words", "packed", "cand", "hits")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    out = docs.withColumn(w, words_of(F.col(text)))

    # Each lambda reads the array bound by ``let``, never a column: a filter that Spark pushes below these
    # projections then recomputes an array once a row, not once an element.
    n = F.size(w)
    out = out.withColumn(packed, F.when(n < 3, F.array().cast("array<bigint>")).otherwise(F.sort_array(let(
        F.col(w), lambda a: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(a), F.lit(3)) - 3),
            lambda i: F.shiftleft(F.xxhash64(F.get(a, i), F.get(a, i + 1), F.get(a, i + 2))
                                  .bitwiseAND(F.lit(0xFFFFFFFF)), 31).bitwiseOR(i.cast("long")))))))

    def near(a, p, k):
        me = F.shiftright(p, 31)
        return (me == F.shiftright(F.get(a, k - 1), 31)) | (me == F.shiftright(F.get(a, k + 1), 31))

    out = out.withColumn(cand, let(F.col(packed), lambda a: F.filter(a, lambda p, k: near(a, p, k))))

    def gram(a, p):
        i = p.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
        return F.struct(F.concat_ws(" ", *[F.get(a, i + j) for j in range(3)]).alias("g"), i.alias("i"))

    out = out.withColumn(hits, F.sort_array(let(F.col(w), lambda a: F.transform(F.col(cand), lambda p: gram(a, p)))))
    twice = let(F.col(hits), lambda a: F.filter(
        a, lambda h, k: (h["g"] == F.get(a, k - 1)["g"]) | (h["g"] == F.get(a, k + 1)["g"])))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        twice, lambda h: F.array(h["i"], h["i"] + 1, h["i"] + 2)))))
    line = free_name(docs, "lines")[0]
    return (out.withColumn(line, lines)
            .withColumns({
                "n_words": n.cast("long"),
                "word_chars": F.length(F.array_join(w, "")).cast("long"),
                "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
                "n_dup_lines": (F.size(line) - F.size(F.array_distinct(line))).cast("long"),
                "n_lines": F.size(line).cast("long"),
                "n_repeat_words": F.when(F.size(cand) == 0, F.lit(0)).otherwise(covered).cast("long")})
            .drop(w, packed, cand, hits, line))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def default_rules(text: str = "text") -> dict[str, Column]:
    """Rules on a row that carries the base measures and its text; true: reject."""
    t = F.coalesce(F.col(text), F.lit(""))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))
    return {
        "symbols": F.col("n_symbols") * 4 > F.col("n_words"),
        "short_words": F.col("word_chars") < F.col("n_words") * 2,
        "long_words": F.col("word_chars") > F.col("n_words") * 20,
        "dup_lines": F.col("n_dup_lines") * 2 > F.col("n_lines"),
        "few_letters": letters * 2 < F.col("word_chars"),
    }


def order_rules(rows: DataFrame, rules: dict[str, Column], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per second on a sample of about ``sample_rows`` rows, best first.

    The order may differ between runs, as timings do; no verdict depends on it.
    """
    some = written(rows.sample(min(1.0, sample_rows / max(rows.count(), 1)), seed=4), "rule_sample")
    n = some.count()
    if n == 0:
        return list(rules)

    def seconds(df: DataFrame) -> float:
        began = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds(some)
    floor = seconds(some)
    gain = {}
    for name, rule in rules.items():
        tested = some.select(F.count_if(F.coalesce(rule, F.lit(False))).alias("n"))
        began = time.perf_counter()
        rejected = tested.first()["n"]
        cost = max(time.perf_counter() - began - floor, 1e-4) / n
        gain[name] = (rejected + 0.5) / n / cost
    return sorted(rules, key=lambda name: (-gain[name], name))


def cascade(rows: DataFrame, rules: dict[str, Column], out: str, first: Column | None = None,
            order: list[str] | None = None) -> DataFrame:
    """``rows`` with Boolean ``out``: false where ``first`` or any rule rejects, tested in the measured order.

    A rule that is null rejects nothing.
    """
    chain = F.when(F.coalesce(first, F.lit(False)), False) if first is not None else F.when(F.lit(False), False)
    for name in order or order_rules(rows, rules):
        chain = chain.when(F.coalesce(rules[name], F.lit(False)), False)
    return rows.withColumn(out, chain.otherwise(True))


def judge(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, the base measures, base_failed and kept for every document.

    The rules' order is measured on a sample of raw documents, so the whole table is read once.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    rules = default_rules()
    share = min(1.0, SAMPLE_ROWS / max(slim.count(), 1))
    sample = written(measures(slim.sample(share, seed=4)), "quality_sample")
    order = order_rules(sample.filter(~base_failed()), rules)
    out = cascade(measures(slim).withColumn("base_failed", base_failed()), rules, "kept", F.col("base_failed"), order)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")
