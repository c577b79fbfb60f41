"""Runs: stretches of words that repeat with a period, found by Lyndon roots and suffix-tree extensions.

Every run (a stretch of at least twice its smallest period that cannot be made longer) begins one of its periods with a
longest Lyndon word of the text, under the order of the words or its reverse.  So for each word the next smaller and the next
greater suffix end a candidate root; common extensions to the right (suffix tree of the text) and to the left
(suffix tree of its reversal) show how far the period holds.  That is all: at most two candidates a word, each tested in constant
time (``suffixtree``).

Only runs of ``min_power`` periods and ``min_length`` words or more are wanted.  Each window of ``min_length`` - 1 words of such a
run occurs again inside the run (for 4 or more periods), so words outside all windows that the text repeats are in no
run; a single symbol of its own stands for each stretch of them in the trees, which leaves the runs as they are.

Rows are independent: one pass, no shuffle; memory of a task is a slice of texts and the trees of one.

Defined results: a null or blank text has no words, no runs and an empty collapsed text; a null id is kept; very long
texts are handled whole; repeated rows give a row each; an empty table gives an empty result; other columns are left
alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsight.llm.common import let, words_of
from runsight.llm.suffixtree import Extensions

MIN_LENGTH, MIN_POWER = 6, 4
#: Texts (and words) that are looked at together.
SLICE_TEXTS, SLICE_WORDS = 256, 400_000
RUNS = "array<struct<start: long, length: long, period: long>>"


def lyndon_ends(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix but the empty last one, the next smaller and the next greater one (n: none is greater)."""
    r = rank.tolist()
    n = len(r) - 1
    small, great = [0] * n, [0] * n
    down, up = [], []  # ranks still open, growing and falling
    for j, v in enumerate(r):
        while down and r[down[-1]] > v:
            small[down.pop()] = j
        down.append(j)
        if j < n:
            while up and r[up[-1]] < v:
                great[up.pop()] = j
            up.append(j)
    for i in up:
        great[i] = n
    return np.array(small, np.int64), np.array(great, np.int64)


def runs_of(s: np.ndarray, min_length: int = 2, min_power: int = 2) -> np.ndarray:
    """(start, length, period) rows, by start and period, of the runs of ``s`` (numbers from 1)."""
    n = len(s)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    ahead, back = Extensions(s), Extensions(s[::-1])
    small, great = lyndon_ends(ahead.rank)
    i = np.tile(np.arange(n), 2)
    j = np.concatenate([small, great])
    real = np.ones(2 * n, bool)
    real[n:] = great < n
    i, j = i[real], j[real]
    p = j - i
    right = ahead.common(i, j)
    left = back.common(n - i, n - j)
    start, length = i - left, left + p + right
    long = (length >= min_power * p) & (length >= min_length)
    found = np.unique(np.stack([start[long], length[long], p[long]], 1), axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def repeated_windows(codes: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Marks the words in windows of ``width`` words that occur twice or more in their text.

    Windows are compared by a 64-bit mix: equal ones never differ, so no word of a run is left out.
    """
    n = len(codes) - width + 1
    mark = np.zeros(len(codes) + 1, np.int64)
    if n <= 0:
        return mark[:-1] > 0
    h = text[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(width):
        h = (h ^ codes[k:k + n]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    inside = np.flatnonzero(text[:n] == text[width - 1:])
    order = inside[np.argsort(h[inside], kind="stable")]
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    hit = np.unique(np.concatenate([order[same], order[same + 1]]))
    np.add.at(mark, hit, 1)
    np.add.at(mark, hit + width, -1)
    return np.cumsum(mark[:-1]) > 0


def marked_runs(words: list[bytes], inside: np.ndarray, min_length: int, min_power: int) -> np.ndarray:
    """Runs of ``words`` that lie in the stretches of marked words; each other stretch becomes one symbol."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    spans = [(a, b) for a, b in edge.reshape(-1, 2).tolist() if b - a >= min_length]
    if not spans:
        return np.zeros((0, 3), np.int64)
    number: dict[bytes, int] = {}
    symbols, place = [], []
    for a, b in spans:
        symbols += [number.setdefault(w, len(number) + 1) for w in words[a:b]]
        place += range(a, b)
        symbols.append(0)
        place.append(b)
    symbols, place = np.array(symbols[:-1], np.int64), np.array(place[:-1], np.int64)
    gap = np.flatnonzero(symbols == 0)
    symbols[gap] = len(number) + 1 + np.arange(len(gap))
    found = runs_of(symbols, min_length, min_power)
    found[:, 0] = place[found[:, 0]]
    return found


def _slices(texts: list):
    """Consecutive texts with their words, a bounded number of words at a time (a longer text alone)."""
    part, n = [], 0
    for t in texts:
        words = (t or "").encode().split()  # bytes split at space, tab, LF, VT, FF and CR only
        if part and n + len(words) > SLICE_WORDS:
            yield part
            part, n = [], 0
        part.append(words)
        n += len(words)
    if part:
        yield part


def find(docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_length: int = MIN_LENGTH,
         min_power: int = MIN_POWER) -> DataFrame:
    """doc_id, runs (start, length, period in words, by start and period) and collapsed of every document.

    ``collapsed`` holds the words, joined by one space, that no run contains after its first period.
    """
    if min_power < 4 or min_length < 6:
        raise ValueError("repeated windows are sure to mark runs of 4 periods and 6 words or more only")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_TEXTS):
                part = batch.slice(at, SLICE_TEXTS)
                first = 0
                for split in _slices(part.column(1).to_pylist()):
                    yield rows(part.column(0).slice(first, len(split)), split)
                    first += len(split)

    def rows(ids, split):
        sizes = np.array([len(w) for w in split], np.int64)
        ends = np.cumsum(sizes)
        codes = np.fromiter((hash(w) for words in split for w in words), np.int64, int(ends[-1])).view(np.uint64)
        inside = repeated_windows(codes, np.repeat(np.arange(len(split)), sizes), min_length - 1)
        runs, texts = [], []
        for words, a, b in zip(split, (ends - sizes).tolist(), ends.tolist(), strict=True):
            found = marked_runs(words, inside[a:b], min_length, min_power)
            if len(found):
                drop = np.zeros(b - a + 1, np.int64)
                np.add.at(drop, found[:, 0] + found[:, 2], 1)
                np.add.at(drop, found[:, 0] + found[:, 1], -1)
                words = [words[k] for k in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
            runs.append(found)
            texts.append(b" ".join(words))
        every = np.concatenate(runs)
        at = np.cumsum([0, *[len(r) for r in runs]])
        items = pa.StructArray.from_arrays([pa.array(every[:, c]) for c in range(3)], ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [ids, pa.ListArray.from_arrays(pa.array(at, pa.int32()), items), pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, runs {RUNS}, collapsed string")


def made_periodic(doc_id: Column, text: Column) -> Column:
    """The text itself, or, for a tenth of the ids by CRC-32, its words from one place on repeated with a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.size(w).cast("long")
        def at(a):
            p = 1 + F.floor((n - a) / (3 + g % 8))
            return F.concat_ws(" ", F.transform(
                w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))))
        return F.when(n > 0, let(g % n, at))

    return F.when(h % 10 == 0, F.coalesce(let(words_of(text), repeated), F.lit(""))).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """The result of ``find`` as numbers: doc_id, n_runs, the run of greatest length / period, and hashes."""
    def line(r):
        return F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))

    def before(a, b):
        """Order of two runs: the greater power, then the smaller start, then the smaller period."""
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    runs = F.col("runs")
    some = F.reduce(runs, F.get(runs, F.lit(0)), lambda a, b: F.when(before(b, a) < 0, b).otherwise(a))
    best = found.withColumn("best", some)
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
