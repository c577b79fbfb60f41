"""Vector code compression: product quantisation whose entries are found by Orchard search.

A vector is cut into equal consecutive parts; each part is replaced by the index of the nearest entry of its
position's codebook.  Orchard search finds that entry: every entry has the list of all other entries in the order of
their distance to it; a query walks the list of its current entry, jumps to the list of the first entry that is nearer,
marks what it has compared, and stops at the first entry farther from the current one than twice the query's own
distance, as by the triangle inequality nothing behind can be nearer.  All parts of a slice walk in step.

Arithmetic is in integers, so any order of rows and any partitioning give the same codebooks.  A codebook has ``entries``
rows, whatever the table's size: it travels with the task, and a round sends one count and sum an entry to the shuffle.

Defined results: a null vector, a null, NaN or infinite component, an empty vector or one of another length than
that of the smallest id drop the row; components beyond +-2**18 count as +-2**18; a length that the parts do not divide is cut
as evenly as it can be; rows with a null id are coded, but give first entries only when other rows are too few; rows
that repeat an id count each, ordered by vector; fewer rows than ``entries`` give a smaller codebook; an empty table gives
an empty result; other columns are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsight.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Scaled components stay within this size, so that sums of squares fit 64 bits.
LARGEST = 2 ** 26
#: A label with at least 1 / SHARE of the rows is joined map-side; there are at most SHARE of them.
SHARE = 1000
#: Rows whose parts walk together.
SLICE = 2048


def whole_numbers(rows: DataFrame, vector: str = "embedding", id_col: str = "vec_id", label: str = "label") -> DataFrame:
    """(vec_id, label, x) of the sound rows, components scaled and floored, written."""
    v = F.col(vector)
    scaled = F.transform(v, lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE), F.lit(LARGEST)),
                                                 F.lit(-LARGEST)).cast("int"))
    sound = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < float("inf"))) & (F.size(v) > 0)
    kept = written(rows.filter(F.coalesce(sound, F.lit(False)))
                   .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).alias("label"), scaled.alias("x")),
                   "vectors")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), F.size("x")).select(F.size("x").alias("n")).first()
    return kept.filter(F.size("x") == (first["n"] if first else 0))


def cuts(width: int, parts: int) -> np.ndarray:
    """Where the parts of a vector begin, and its end."""
    return np.arange(parts + 1) * width // parts


class Codebooks:
    """One codebook a part; ``tables`` are arrays (entries, components of the part) of whole numbers."""

    def __init__(self, tables: list[np.ndarray]):
        self.tables = [np.asarray(t, np.int64) for t in tables]
        self.parts, self.k = len(tables), len(tables[0]) if tables else 0
        self.ends = np.cumsum([0, *[t.shape[1] for t in self.tables]])
        deep = max((t.shape[1] for t in self.tables), default=0)
        # parts of one position are padded with zeros to the widest part: distances stay the same
        self.flat = np.zeros((self.parts * self.k, deep), np.int64)
        for p, t in enumerate(self.tables):
            self.flat[p * self.k:(p + 1) * self.k, :t.shape[1]] = t
        gap = [((t[:, None] - t[None]) ** 2).sum(-1) for t in self.tables]
        for g in gap:
            np.fill_diagonal(g, -1)
        order = [np.argsort(g, axis=1, kind="stable") for g in gap]
        #: Other entries of each entry by distance, as positions in ``flat``; a stop row at the end.
        self.near = np.zeros((self.parts * self.k, self.k), np.int64)
        self.gap = np.full((self.parts * self.k, self.k), 2 ** 62)
        for p, (g, o) in enumerate(zip(gap, order, strict=True)):
            at = slice(p * self.k, (p + 1) * self.k)
            self.near[at, :-1] = o[:, 1:] + p * self.k
            self.gap[at, :-1] = np.take_along_axis(g, o, 1)[:, 1:]
        #: The walk begins at the entry that is nearest to all others.
        self.start = np.array([int(g.sum(1).argmin()) + p * self.k for p, g in enumerate(gap)], np.int64)

    def queries(self, x: np.ndarray) -> np.ndarray:
        """The parts of the rows of ``x``, one a row, padded like the entries."""
        out = np.zeros((len(x), self.parts, self.flat.shape[1]), np.int64)
        for p in range(self.parts):
            a, b = self.ends[p], self.ends[p + 1]
            out[:, p, :b - a] = x[:, a:b]
        return out.reshape(len(x) * self.parts, -1)

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance), each (rows, parts): the nearest entry, of equal ones the lowest."""
        q = self.queries(x)
        n = len(q)
        now = np.tile(self.start, len(x))
        low = now - now % self.k if self.k else now
        off = q - self.flat[now]
        best = np.einsum("ij,ij->i", off, off)
        seen = np.zeros(n * self.k, bool)
        seen[np.arange(n) * self.k + now - low] = True
        at = np.zeros(n, np.int64)
        near, gap, width = self.near.ravel(), self.gap.ravel(), self.k
        live = np.arange(n)
        while live.size:
            place = now[live] * width + at[live]
            live_on = (gap[place] + 3) >> 2 <= best[live]  # gap <= 4 * best: twice the distance, squared
            live, place = live[live_on], place[live_on]
            other = near[place]
            at[live] += 1
            mark = live * width + other - low[live]
            fresh = ~seen[mark]
            i, j = live[fresh], other[fresh]
            seen[mark[fresh]] = True
            off = q[i] - self.flat[j]
            d = np.einsum("ij,ij->i", off, off)
            better = (d < best[i]) | ((d == best[i]) & (j < now[i]))
            i = i[better]
            now[i], best[i], at[i] = j[better], d[better], 0
        return (now - low).reshape(len(x), self.parts), best.reshape(len(x), self.parts)

    def moved(self, counts: np.ndarray, sums: np.ndarray) -> Codebooks:
        """Entries replaced by the floored means of their parts; unused entries stay."""
        mean = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], self.flat)
        return Codebooks([mean[p * self.k:(p + 1) * self.k, :t.shape[1]] for p, t in enumerate(self.tables)])

    def sha256(self) -> str:
        line = ",".join(str(c) for t in self.tables for c in t.ravel().tolist())
        return hashlib.sha256(line.encode()).hexdigest()


def _slices(batches, width: int):
    """(batch slice, vectors as an array) in bounded pieces."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            x = part.column(part.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False)
            yield part, x.astype(np.int64).reshape(part.num_rows, width)


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """Codebooks of the rows with the smallest ids; at most ``entries`` rows reach the driver."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    ids = [r[0] for r in rows.select("vec_id").orderBy(order[0]).limit(entries).collect()]
    some = rows if not ids or ids[-1] is None else rows.filter(F.col("vec_id") <= ids[-1])
    x = np.array([r["x"] for r in some.select("vec_id", "x").orderBy(*order).limit(entries).collect()], np.int64)
    if not len(x):
        return Codebooks([])
    ends = cuts(x.shape[1], parts)
    return Codebooks([x[:, a:b] for a, b in zip(ends, ends[1:], strict=False)])


def trained(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, then every entry to the floored mean of its parts."""
    deep, width, total = books.flat.shape[1], int(books.ends[-1]), len(books.flat)
    names = ["entry", "n", *[f"s{c}" for c in range(deep)]]

    def run(batches):
        n, s = np.zeros(total, np.int64), np.zeros((total, deep), np.int64)
        for _, x in _slices(batches, width):
            entry = (books.search(x)[0] + np.arange(books.parts) * books.k).ravel()
            q = books.queries(x)
            n += np.bincount(entry, minlength=total)
            for c in range(deep):  # sums of a slice are exact in doubles
                s[:, c] += np.bincount(entry, weights=q[:, c], minlength=total).astype(np.int64)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(n[used]),
                                          *[pa.array(s[used, c]) for c in range(deep)]], names)

    got = (rows.select("x").mapInArrow(run, ", ".join(f"{c} long" for c in names)).groupBy("entry")
           .agg(*[F.sum(c).alias(c) for c in names[1:]]).collect())
    n, s = np.zeros(total, np.int64), np.zeros((total, deep), np.int64)
    for r in got:
        n[r["entry"]], s[r["entry"]] = r["n"], [r[c] for c in names[2:]]
    return books.moved(n, s)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from all of ``rows`` (the result of ``whole_numbers``)."""
    books = first_books(rows, parts, entries)
    for _ in range(rounds if books.k else 0):
        books = trained(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (array of entries), error of every row."""
    width = int(books.ends[-1])

    def run(batches):
        for part, x in _slices(batches, width):
            entry, gap = books.search(x)
            code = pa.FixedSizeListArray.from_arrays(pa.array(entry.ravel().astype(np.int32)), books.parts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), code.cast(pa.list_(pa.int32())), pa.array(gap.sum(1))],
                ["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "x").mapInArrow(
        run, f"vec_id long, label {label}, code array<int>, error long")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with x, the vector of whole numbers that the code stands for."""
    tables = [F.array(*[F.array(*[F.lit(int(c)) for c in row]) for row in t]) for t in books.tables]
    x = F.flatten(F.array(*[F.get(t, F.col("code")[p]) for p, t in enumerate(tables)]))
    return codes.withColumn("x", x)


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` (a written table) with label_error: the errors of equal labels summed, nulls together."""
    sums = written(codes.groupBy(F.col("label").alias("_label"))
                   .agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n")), "label_errors")
    total = codes.count()
    often = sums.filter(F.col("_n") * SHARE >= total)  # at most SHARE labels
    cond = codes["label"].eqNullSafe(F.col("_label"))
    heavy = codes.join(F.broadcast(often), cond)
    light = (codes.join(F.broadcast(often.select("_label")), cond, "left_anti")
             .withColumn("label_error", F.sum("error").over(Window.partitionBy("label"))))
    order = [*codes.columns, "label_error"]
    return light.select(order).unionByName(heavy.select(order))


def compressed(rows: DataFrame, vector: str = "embedding", id_col: str = "vec_id", label: str = "label",
               parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every sound row."""
    x = whole_numbers(rows, vector, id_col, label)
    books = fit(x, parts, entries, rounds)
    if not books.k:
        return encode(x, Codebooks([np.zeros((1, 1))])).limit(0).withColumns(
            {"label_error": F.lit(None).cast("long"), "codebooks_sha256": F.lit(None).cast("string")})
    codes = written(encode(x, books), "vector_codes")
    return label_errors(codes).withColumn("codebooks_sha256", F.lit(books.sha256()))
