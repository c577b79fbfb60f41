"""Repeated passages by sparse suffix arrays.

Passages of MIN words or more that occur twice anywhere (across documents or within one) are found on word hashes.
Only suffixes at minimiser positions are kept: of every SPAN consecutive GRAM-word grams the one with the least
hash, so any two equal runs of MIN words hold a common kept position.  Positions whose gram occurs once are dropped
by a map-side combined count.  The others, with the words to their right and left as sort keys, are sorted
globally (by range, ties broken by document and position, so no passage is one task); neighbours in the sorted
suffixes are compared and their match extended left and right.  A second sort by the words to the left gives the
longest match on that side.

Neighbours alone can miss a partner that is second best on both sides.  The two orders bound which windows of MIN words
around a position can match; where a feasible window is not settled by a neighbour, an exact check groups the
windows of that gram by hash.  The result is every run of MIN words that occurs twice.

Defined results: case is folded in A-Z, blanks do not count; texts under MIN words (or null) have no passages; rows are
told apart by id and text, so several texts of one id are searched each on its own, their passages listed under the id;
rows with a null id count like others, their passages have a null doc_id; a row that repeats another repeats its
passages; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.llm.common import written
from runsight.llm.minhash import mixed, word_hashes

MIN = 50
GRAM = 8
SPAN = MIN - GRAM + 1
SIDE = MIN - GRAM
#: A gram with at least 1 / SHARE of the kept positions is joined map-side; there are at most SHARE of them.
SHARE = 1000
#: Ends of sorted ranges that one task compares.
ENDS = 20_000
#: Stands for a null id.
NO_ID = -2 ** 63
_MUL = mixed(np.arange(1, GRAM + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def grams(h: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM-word grams at each position."""
    n = len(h) - GRAM + 1
    out = np.zeros(n, np.uint64)
    for j in range(GRAM):
        out += h[j:j + n] * _MUL[j]
    return mixed(out)


def minimisers(g: np.ndarray) -> np.ndarray:
    """Positions of the least gram of each SPAN consecutive ones, the first of equals."""
    out = [np.zeros(0, np.int64)]
    for a in range(0, len(g) - SPAN + 1, 100_000):
        part = np.lib.stride_tricks.sliding_window_view(g[a:a + 100_000 + SPAN - 1], SPAN)
        out.append(np.unique(part.argmin(1) + np.arange(a, a + len(part))))
    return np.unique(np.concatenate(out))


def positions(docs: DataFrame) -> DataFrame:
    """(gram, row, pos) of all minimisers."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                gram, row, pos = [], [], []
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    h = word_hashes(t)
                    if len(h) >= MIN:
                        g = grams(h)
                        at_ = minimisers(g)
                        gram.append(g[at_].view(np.int64))
                        pos.append(at_)
                        row.append(np.full(len(at_), d))
                if gram:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(gram)), pa.array(np.concatenate(row)),
                         pa.array(np.concatenate(pos).astype(np.int32))], ["gram", "row", "pos"])

    return docs.select("row", "text").mapInArrow(run, "gram long, row long, pos int")


def told_apart(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): row is the id where that is one row's own (small numbers stay small in all that is written),
    else a hash of id and text; NO_ID stands for a null id on the way."""
    shared = written(docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
                     .filter("n > 1").select("doc_id"), "repeated_ids")
    row = F.coalesce("doc_id", F.xxhash64("text"))
    if not shared.isEmpty():
        docs = docs.join(shared.withColumn("shared", F.lit(True)), "doc_id", "left")
        row = F.when(F.col("shared"), F.xxhash64("doc_id", "text")).otherwise(row)
    return docs.select(row.alias("row"), F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")


def with_gram(rows: DataFrame, wanted: DataFrame, heavy: DataFrame) -> DataFrame:
    """The rows whose gram is in ``wanted``; the ``heavy`` grams (at most SHARE) are matched map-side."""
    hot = wanted.select("gram").join(F.broadcast(heavy), "gram")
    rest = rows.join(F.broadcast(heavy), "gram", "left_anti").join(wanted.select("gram"), "gram", "left_semi")
    return rest.unionByName(rows.join(F.broadcast(hot), "gram", "left_semi").select(rest.columns))


_CONTEXT = "gram long, row long, doc_id long, pos int, n_right int, n_left int, right binary, left binary"


def contexts(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Repeated positions with up to SIDE word hashes on each side, nearest first, as sortable bytes."""
    names = [c.split()[0] for c in _CONTEXT.split(", ")]

    def run(batches):
        for batch in batches:
            rows = [[] for _ in names]
            for k, d, t, at in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                h = word_hashes(t)
                g, short = grams(h).view(np.int64), (h >> np.uint64(32)).astype(">u4")
                for p in sorted(set(at)):
                    right, left = short[p + GRAM:p + GRAM + SIDE], short[max(0, p - SIDE):p][::-1]
                    for column, value in zip(rows, (int(g[p]), k, d, p, len(right), len(left),
                                                    right.tobytes().ljust(4 * SIDE, b"\0"),
                                                    left.tobytes().ljust(4 * SIDE, b"\0")), strict=True):
                        column.append(value)
                if len(rows[0]) > 5000:
                    yield table(rows)
                    rows = [[] for _ in names]
            yield table(rows)

    def table(rows):
        kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names)

    return docs.join(repeated, "row").select("row", "doc_id", "text", "at").mapInArrow(run, _CONTEXT)


def _side(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(-1, SIDE)


def _common(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Equal leading values of each row and the next, within both lengths."""
    same = (x[1:] == x[:-1]) & (np.arange(SIDE) < np.minimum(n[1:], n[:-1])[:, None])
    return np.where(same.all(1), SIDE, same.argmin(1))


def windows(right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Bit o is set if a match of these lengths holds the window of MIN words that begins o words before."""
    low, high = SIDE - np.minimum(right, SIDE), np.minimum(left, SIDE)
    one = np.int64(1)
    return np.where(low <= high, (one << (high + 1).astype(np.int64)) - (one << np.minimum(low, 62).astype(np.int64)), 0)


def neighbours(rows: DataFrame, order: list[str]) -> DataFrame:
    """Matches of each suffix with its neighbours in ``order``: (gram, row, doc_id, pos, r, l, covered, other)."""
    names = ["gram", "row", "doc_id", "pos", "r", "l", "covered", "other"]
    schema = "gram long, row long, doc_id long, pos int, r int, l int, covered long, other long"
    kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.int64()] * 2

    def compare(cols):
        gram, row, doc, pos, n_right, n_left = cols[:6]
        r, n = _common(cols[6], n_right), _common(cols[7], n_left)
        pair = np.flatnonzero(gram[1:] == gram[:-1])
        r, n = r[pair], n[pair]
        mask = windows(r, n)
        a, b = pair, pair + 1
        both = [*[np.concatenate([x[a], x[b]]) for x in (gram, row, doc, pos)],
                np.concatenate([r, r]).astype(np.int32), np.concatenate([n, n]).astype(np.int32),
                np.concatenate([mask, mask]), np.concatenate([doc[b], doc[a]])]
        return [pa.array(x) for x in both]

    def run(batches):
        held, edge, seen = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            seen += batch.num_rows
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)] + [
                _side(batch.column(6)), _side(batch.column(7))]
            edge.append(batch.slice(0, 1)) if held is None else None
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols, strict=True)]
            found = compare(cols)
            held = [c[-1:] for c in cols]
            last = batch.slice(batch.num_rows - 1, 1)
            empty = [pa.nulls(len(found[0]), f.type) for f in last.schema]
            yield pa.RecordBatch.from_arrays([*found, *empty], [*names, *[f"e_{f.name}" for f in last.schema]])
        if held is not None:
            # a task's only row is one end, not two: it must not meet itself
            ends = pa.Table.from_batches([*edge, last] if seen > 1 else edge).combine_chunks().to_batches()[0]
            none = [pa.nulls(ends.num_rows, t) for t in kinds]
            yield pa.RecordBatch.from_arrays([*none, *ends.columns], [*names, *[f"e_{f.name}" for f in ends.schema]])

    whole = schema + ", " + ", ".join(f"e_{c}" for c in _CONTEXT.split(", "))
    cols = [c.split()[0] for c in _CONTEXT.split(", ")]
    sort = [*order, "row", "pos"]

    def compared(dealt: DataFrame) -> DataFrame:
        return written(dealt.sortWithinPartitions(*sort).mapInArrow(run, whole), "neighbours")

    # Ranges go by the first side only: ties on it have the longest match there, wherever they are cut.
    cut = [*order[:2], "row", "pos"]
    out = [compared(rows.select(cols).repartitionByRange(*cut))]
    while True:  # the first and last suffix of each task are compared once more across tasks, ENDS of them in one
        ends = out[-1].filter(F.col("e_gram").isNotNull()).select(*[F.col(f"e_{c}").alias(c) for c in cols])
        n = -(-ends.count() // ENDS)
        out.append(compared(ends.repartitionByRange(n, *cut) if n > 1 else ends.repartition(1)))
        if n <= 1:
            break
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every.filter(F.col("gram").isNotNull()).select(names)


def settled(found: DataFrame) -> DataFrame:
    """Per position: windows covered, windows that no neighbour settles (open), and a partner.  Written."""
    best = found.groupBy("gram", "row", "doc_id", "pos").agg(
        F.max("r").alias("r"), F.max("l").alias("l"), F.bit_or("covered").alias("covered"),
        F.min(F.when(F.col("covered") != 0, F.col("other"))).alias("low"),
        F.max(F.when(F.col("covered") != 0, F.col("other"))).alias("high"))
    one = F.lit(1).cast("long")

    def shifted(by):
        return F.call_function("shiftleft", one, by)

    feasible = F.when(SIDE - F.col("r") <= F.col("l"), shifted(F.col("l") + 1) - shifted(SIDE - F.col("r"))).otherwise(0)
    return written(best.withColumn("feasible", feasible.cast("long")).withColumn(
        "open", F.col("feasible").bitwiseAND(F.bitwise_not("covered"))), "settled")


def checked(rows: DataFrame, known: DataFrame, heavy: DataFrame) -> DataFrame:
    """(gram, row, doc_id, pos, covered, low, high) of the feasible windows that occur twice, for grams with open ones."""
    todo = known.filter("open != 0").select("gram").distinct()
    some = rows.join(with_gram(known.filter("feasible != 0").select("gram", "row", "pos", "feasible"), todo, heavy),
                     ["gram", "row", "pos"])
    power = np.multiply.accumulate(np.full(SIDE, 0xD1342543DE82EF95, np.uint64))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                gram, row, doc, pos, mask = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3, 6))
                right, left = _side(part.column(4)).astype(np.uint64), _side(part.column(5)).astype(np.uint64)
                zero = np.zeros((len(gram), 1), np.uint64)
                rs = np.hstack([zero, np.cumsum(right * power, axis=1, dtype=np.uint64)])
                ls = np.hstack([zero, np.cumsum(left * power, axis=1, dtype=np.uint64)])
                i, o = np.nonzero((mask[:, None] >> np.arange(SIDE + 1)) & 1)
                key = mixed(mixed(ls[i, o]) * np.uint64(3) + mixed(rs[i, SIDE - o] ^ np.uint64(1))
                            + gram[i].view(np.uint64)) + o.astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mixed(key).view(np.int64)), pa.array(gram[i]), pa.array(row[i]), pa.array(doc[i]),
                     pa.array(pos[i]), pa.array(o.astype(np.int32))], ["window", "gram", "row", "doc_id", "pos", "o"])

    seen = written(some.select("gram", "row", "doc_id", "pos", "right", "left", "feasible").mapInArrow(
        run, "window long, gram long, row long, doc_id long, pos int, o int"), "windows")
    twice = seen.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"),
                                       F.max("doc_id").alias("high")).filter("n > 1")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("o"))
    return seen.join(twice, "window").groupBy("gram", "row", "doc_id", "pos").agg(
        F.bit_or(bit).alias("covered"), F.min("low").alias("low"), F.max("high").alias("high"))


def passages(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, end, n_words, other_id) of each maximal repeated stretch; words start to end - 1 of the text.

    Every word of it lies in a run of MIN words that occurs again; other_id is a document that shares such a run
    (the document itself if it only repeats itself).
    """
    docs = told_apart(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    sparse = written(positions(docs), "minimisers")
    twice = written(sparse.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated_grams")
    heavy = twice.filter(F.col("n") * SHARE >= sparse.count()).select("gram")
    at = written(with_gram(sparse, twice, heavy).groupBy("row").agg(F.collect_set("pos").alias("at")), "repeated")
    rows = written(contexts(docs, at), "suffixes")
    found = neighbours(rows, ["gram", "right", "left"]).unionByName(neighbours(rows, ["gram", "left", "right"]))
    known = settled(found)
    cols = ["row", "doc_id", "pos", "covered", "low", "high"]
    hits = known.filter("covered != 0").select(cols).unionByName(checked(rows, known, heavy).select(cols))
    own = F.col("doc_id")
    other = F.when(F.col("low") != own, F.col("low")).otherwise(F.col("high"))
    per = hits.select("row", "doc_id", F.struct("pos", "covered", other.alias("other")).alias("hit")).groupBy(
        "row", "doc_id").agg(F.collect_list("hit").alias("hits")).select("doc_id", "hits")

    def merge(batches):
        for batch in batches:
            out = []
            for d, hits_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                runs = []
                for h in hits_:
                    bits = h["covered"]
                    while bits:
                        low = (bits & -bits).bit_length() - 1
                        high = low
                        while bits >> (high + 1) & 1:
                            high += 1
                        runs.append((h["pos"] - high, h["pos"] - low + MIN, h["other"]))
                        bits &= ~((1 << (high + 1)) - 1)
                runs.sort()
                start, end, partner = runs[0]
                for a, b, o in runs[1:]:
                    if a > end:
                        out.append((d, start, end, end - start, partner))
                        start, end, partner = a, b, o
                    else:
                        end = max(end, b)
                        partner = min((x for x in (partner, o) if x != d), default=d)
                out.append((d, start, end, end - start, partner))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)],
                                             ["doc_id", "start", "end", "n_words", "other_id"])

    spans = per.mapInArrow(merge, "doc_id long, start long, end long, n_words long, other_id long")
    return spans.withColumns({c: F.nullif(c, F.lit(NO_ID)) for c in ("doc_id", "other_id")})
