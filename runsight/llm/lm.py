"""Language-model scoring with an Elias-Fano n-gram trie.

Tokens: words lower-cased in A-Z, then one end token a text.  Training texts are those whose CRC-32 of the doc_id
(as text) is not divisible by 10.  Unigrams: add 0.1, over all training tokens.  Bigrams and trigrams that occur
LEAST times or more, of all words: absolute discounting, interpolated with the next lower order; what the other
continuations leave goes to the lower order too, so each context's probabilities sum to one (before they are
quantised to 8 bits).  LEAST is a count, so the model grows with the corpus.

A word that holds 2^-IN_MEMORY of the tokens (so there are at most 2^IN_MEMORY of them) has its id and its count in
memory; any other word is named by 62 bits of its hash and meets its count in an ordinary join.  That decides only
where a count is read, never what is scored.

The trie is cut into shards by the middle word v of (u, v, w), about PER_SHARD tokens each, so their number grows with
the corpus; a frequent v is cut further by u (at most SPLIT ways), each cut with all successors of v.  Levels of a
shard: its words' names; (v, w) successors; (v, u) contexts; under each context the rank of w among the successors
of v, which needs fewer bits than w (context-relative).  Each level is one Elias-Fano sequence, pointers into it
another; probabilities and back-off weights are 8-bit codes into a code book.  All tokens travel once, in compressed
blocks, to their shard, whose task counts those of training texts, builds its levels, maps them from an unlinked file
and scores all its tokens by them; sums travel back in blocks.  No shard goes to the driver or to other tasks.
A task holds its shard's tokens (a few bytes each); a pair (u, v) is not cut further.

Defined results: a null or empty text is the end token alone; a null doc_id is held out; rows that repeat are scored
(and learnt from) one by one; an empty table gives an empty result; other columns are not read.  Rows are numbered
within their partition, so ``docs`` is to give its rows in the same order when a task is repeated (files do).
"""

from __future__ import annotations

from collections import Counter
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.llm.common import releasing, shuffles_dropped, sliced, written
from runsight.llm.eliasfano import EliasFano, mapped_arrays, pack_arrays

IN_MEMORY = 20  # share of a word in memory, as a negative power of two
LEAST = 2
PER_SHARD = 1 << 20
LEAST_SHARDS = 16
SPLIT = 256
FLUSH = 1_000_000
DISCOUNT = 0.75
SLICE_TEXTS, SLICE_BYTES = 200, 4_000_000
START = -1  # in the place of u or v: no such token
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(True))


def tokens(text: str | None) -> list[bytes]:
    """The lower-cased words; bytes.split() without an argument splits at exactly the six blanks."""
    return (text or "").encode().translate(_LOWER).split()


def name_of(word: bytes) -> int:
    """The name of a word that is not in memory: above all ids of words that are."""
    return xxhash.xxh3_64_intdigest(word) >> 2 | 1 << 62


def _count(batches):
    seen: Counter = Counter()

    def rows():
        words = list(seen)
        for i in range(0, len(words), 50_000):
            part = words[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([name_of(w) for w in part], pa.int64()),
                                              pa.array([seen[w] for w in part], pa.int64())], ["word", "name", "n"])
        seen.clear()

    for batch in sliced(batches, 0, SLICE_TEXTS, SLICE_BYTES):
        for t in batch.column(0).to_pylist():
            seen.update(tokens(t))
        if len(seen) > 400_000:
            yield from rows()
    yield from rows()


def unigrams(docs: DataFrame, text: str, id_col: str) -> tuple[DataFrame, int, int, int]:
    """(word, name, n) of all training words, written; N, V and the number of training texts, end tokens included."""
    train = docs.filter(~held_out(id_col)).select(F.col(text).cast("string"))
    table = written(train.mapInArrow(releasing(_count), "word binary, name long, n long").groupBy("word", "name")
                    .agg(F.sum("n").alias("n")), "words")
    n, v = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    texts = train.count()
    return table, n + texts, v + (texts > 0), texts


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes of integers."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Words in memory (id 0 is the end token) and the cut into shards."""

    def __init__(self, words: list[tuple[bytes, int]], total: int, distinct: int, texts: int, per_shard: int = PER_SHARD):
        self.total, self.distinct = total, distinct
        ranked = sorted(words, key=lambda x: (-x[1], x[0]))
        self.ids = {b"": 0, **{w: i + 1 for i, (w, _) in enumerate(ranked)}}
        self.counts = np.array([texts, *[n for _, n in ranked]], np.int64)
        self.uni = (self.counts + 0.1) / (total + 0.1 * (distinct + 1))
        self.log_uni = np.log10(self.uni)
        self.shards = max(LEAST_SHARDS, -(-total // per_shard))
        self.cuts = np.clip(-(-self.counts * self.shards // max(total, 1)), 1, SPLIT)

    def cuts_of(self, v: np.ndarray) -> np.ndarray:
        """Shards that each middle word is cut over."""
        inside = (v >= 0) & (v < len(self.cuts))
        return np.where(inside, self.cuts[np.where(inside, v, 0)], 1)

    def uni_of(self, w: np.ndarray) -> np.ndarray:
        """Unigram probabilities; 0 for words that are not in memory."""
        inside = w < len(self.uni)
        return np.where(inside, self.uni[np.where(inside, w, 0)], 0.0)

    def shard(self, v: np.ndarray, cut: np.ndarray) -> np.ndarray:
        return (mixed(mixed(v) + cut.astype(np.uint64)) % np.uint64(self.shards)).astype(np.int64)

    def home(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The shard of each (u, v, w); tokens without a context are spread by w, as no shard knows them."""
        cut = mixed(u) % self.cuts_of(v).astype(np.uint64)
        return self.shard(np.where(v >= 0, v, w), cut)


def frequent_words(table: DataFrame, total: int, distinct: int, texts: int, per_shard: int = PER_SHARD,
                   in_memory: int = IN_MEMORY) -> Vocabulary:
    rows = table.filter(F.col("n") * 2**in_memory >= total).collect()  # at most 2^in_memory by their share of N
    return Vocabulary([(bytes(r["word"]), r["n"]) for r in rows], total, distinct, texts, per_shard)


def _sequence(lines: list[list[bytes]], ids: dict[bytes, int]):
    """Names of all tokens of some texts (0: end), the text of each, and the tokens (u, v) before each."""
    flat = [*chain.from_iterable((*line, b"") for line in lines)]
    seq = np.fromiter(map(ids.get, flat, repeat(-1)), np.int64, len(flat))
    rare = np.flatnonzero(seq < 0)
    if len(rare):
        seq[rare] = [name_of(flat[i]) for i in rare.tolist()]
    sizes = np.array([len(line) + 1 for line in lines], np.int64)
    doc = np.repeat(np.arange(len(lines)), sizes)
    place = np.arange(len(seq)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    v = np.where(place > 0, np.roll(seq, 1), START)
    return seq, doc, v, np.where(place > 1, np.roll(seq, 2), START)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers by byte planes, so that small ones compress to little."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(block: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view(np.int64).ravel() for p in planes]


def _by_shard(shard: np.ndarray, v: np.ndarray, *columns: np.ndarray):
    """(shard, its packed columns), rows ordered by v."""
    order = np.argsort(shard << 22 | np.clip(v, 0, 1 << 21))
    shard, columns = shard[order], [c[order] for c in columns]
    start = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    for a, b in zip(start, [*start[1:], len(shard)], strict=True):
        yield int(shard[a]), _packed(*[c[a:b] for c in columns])


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes and their code book: 256 even steps down from the largest value, which is exact, to the smallest, so
    no value is off by more than 1/510 of their range."""
    if not len(x):
        return np.zeros(0, np.uint8), np.zeros(256)
    top, step = x.max(), max((x.max() - x.min()) / 255, 1e-12)
    return np.round((top - x) / step).astype(np.uint8), top - np.arange(256) * step


def _counted(key: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs (or the sums of their ``n``)."""
    if n is None:
        return np.unique(key, return_counts=True)
    order = np.argsort(key, kind="stable")
    start = np.flatnonzero(np.diff(key[order], prepend=-1))
    return key[order][start], np.add.reduceat(n[order], start) if len(start) else n


def _places(every: np.ndarray, dense: int):
    """A function from names to their places in ``every``: ids below ``dense`` and START by a table, others by search."""
    low = int(np.searchsorted(every, dense))
    table = np.zeros(dense + 1, np.int64)  # START, -1, is its last entry
    table[every[:low]] = np.arange(low)

    def find(x: np.ndarray) -> np.ndarray:
        out = table[np.minimum(x, dense - 1)]
        rare = np.flatnonzero(x >= dense)
        out[rare] = low + np.searchsorted(every[low:], x[rare])
        return out
    return find


def build_shard(v: np.ndarray, u: np.ndarray, w: np.ndarray, more: list[np.ndarray], vocabulary: Vocabulary) -> bytes:
    """The levels of one shard from its training tokens and the counts (v, w, n) of words cut over several shards.

    Probabilities of words that are not in memory leave their unigram part out.
    """
    every = np.unique(np.concatenate([v, u, w, *more[:2]]))
    size = np.int64(len(every) + 1)
    v, u, w, mv, mw = map(_places(every, len(vocabulary.counts)), (v, u, w, *more[:2]))
    whole = vocabulary.cuts_of(every)[v] == 1
    two, n2 = _counted(np.concatenate([(v * size + w)[whole], mv * size + mw]),
                       np.concatenate([np.ones(int(whole.sum()), np.int64), more[2]]))
    after_start = every[u] >= 0
    contexts, own = np.unique((v * size + u)[after_start], return_inverse=True)
    three, tn = _counted(own * size + w[after_start])
    # every occurrence of v, or of (u, v), has a successor: its count
    cv, cn = _counted(two // size, n2)
    pairs, pn = _counted(three // size, tn)
    keep, keep3 = n2 >= LEAST, tn >= LEAST
    two, bn, three, tn = two[keep], n2[keep], three[keep3], tn[keep3]
    count = cn[np.searchsorted(cv, two // size)] if len(two) else np.ones(0)
    pair = pn[np.searchsorted(pairs, three // size)] if len(three) else np.ones(0)
    bv, bw = every[two // size], every[two % size]
    tv, tu, tw = every[contexts[three // size] // size], every[contexts[three // size] % size], every[three % size]
    names = np.unique(np.concatenate([bv, bw, tu]))
    width = max(len(names), 1)
    v2, w2 = np.searchsorted(names, bv), np.searchsorted(names, bw)
    v3, u3, w3 = (np.searchsorted(names, x) for x in (tv, tu, tw))
    flat = v2 * width + w2
    part = (bn - DISCOUNT) / count
    left = np.ones(width)
    np.subtract.at(left, v2, part)
    p2 = part + left[v2] * vocabulary.uni_of(bw)
    pointer = np.searchsorted(v2, np.arange(width + 1))
    arrays = {}

    def put(level: str, values: np.ndarray, universe: int):
        arrays.update({f"{level}.{k}": a for k, a in EliasFano.build(values, universe).items()})

    def put_codes(name: str, x: np.ndarray):
        arrays[name], arrays[f"{name}.book"] = quantised(np.log10(np.maximum(x, 1e-12)))

    put("word", names, 1 << 63)
    put("next", flat, width * width)
    put("pointer", pointer, len(flat) + 1)
    put_codes("p2", p2)
    put_codes("left1", left)
    context, own = np.unique(v3 * width + u3, return_inverse=True)
    at = np.searchsorted(flat, v3 * width + w3)
    ranks = int(np.diff(pointer).max(initial=0)) + 1
    part3 = (tn - DISCOUNT) / pair
    left2 = np.ones(len(context))
    np.subtract.at(left2, own, part3)
    put("context", context, width * width)
    put("rank", np.sort(own * ranks + at - pointer[v3]), len(context) * ranks + 1)
    # the rows are in the order of (v, u, w), so also in that of (context, rank)
    put_codes("p3", part3 + left2[own] * p2[at] if len(tn) else np.zeros(0))
    put_codes("left2", left2)
    arrays["meta"] = np.array([width, ranks], np.int64)
    return pack_arrays(arrays)


def _through(find, x: np.ndarray) -> np.ndarray:
    """``find`` of non-negative numbers, each different one looked up once."""
    kinds, back = np.unique(x, return_inverse=True)
    return find(kinds.astype(np.uint64))[back]


class Shard:
    """A mapped shard; queries take arrays of names."""

    def __init__(self, block: bytes):
        a = mapped_arrays(block)
        self.width, self.ranks = (int(x) for x in a["meta"])
        self.levels = {k: EliasFano({f: a[f"{k}.{f}"] for f in ("low", "high", "ones", "meta")})
                       for k in ("word", "next", "pointer", "context", "rank")}
        self.codes = {k: (a[k], a[f"{k}.book"]) for k in ("p2", "left1", "p3", "left2")}

    def value(self, name: str, i: np.ndarray) -> np.ndarray:
        code, book = self.codes[name]
        return book[code[i]]

    def local(self, x: np.ndarray) -> np.ndarray:
        """Places of names in the shard's words, -1 where they are not."""
        out = np.full(len(x), -1, np.int64)
        real = np.flatnonzero(x >= 0)
        out[real] = _through(self.levels["word"].find, x[real])
        return out

    def score(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a, b) of each token, log10: P(w | u, v) = 10^a, or 10^b * P(w) where a is minus infinity.

        For a word that is not in memory P(w | u, v) = 10^a + 10^b * P(w)."""
        lv, lu, lw = self.local(v), self.local(u), self.local(w)
        a, b = np.full(len(v), -np.inf), np.zeros(len(v))
        inner = lv >= 0
        b[inner] = self.value("left1", lv[inner])
        at = np.full(len(v), -1, np.int64)
        known = np.flatnonzero(inner & (lw >= 0))
        at[known] = _through(self.levels["next"].find, lv[known] * self.width + lw[known])
        hit = at >= 0
        a[hit] = self.value("p2", at[hit])
        two = np.flatnonzero(inner & (lu >= 0))
        context = _through(self.levels["context"].find, lv[two] * self.width + lu[two])
        two, context = two[context >= 0], context[context >= 0]
        left = self.value("left2", context)
        a[two] += left
        b[two] += left
        near = np.flatnonzero(at[two] >= 0)
        if len(near):
            i = two[near]
            rank = at[i] - self.levels["pointer"].access(lv[i]).astype(np.int64)
            found = self.levels["rank"].find((context[near] * self.ranks + rank).astype(np.uint64))
            a[i[found >= 0]] = self.value("p3", found[found >= 0])
        return a, b


def _record_batches(schema: str):
    """A function from columns by name (the others null) to a batch of ``schema``."""
    arrow = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [(name, arrow[kind]) for name, kind in (c.split() for c in schema.split(", "))]

    def batch(n: int, **columns):
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in fields],
                                          [c for c, _ in fields])
    return batch


DOCUMENT, TOKENS, SUCCESSORS = 0, 1, 2
ROW = ("shard int, kind int, key long, block binary, doc_id long, held_out boolean, n_tokens long, n_known long, "
       "base double, score double")


def token_blocks(docs: DataFrame, vocabulary, text: str, id_col: str) -> DataFrame:
    """Rows of ROW.  DOCUMENT: a document with its sums over what needs no shard.  TOKENS: a block of (document * 2 +
    training, u, v, w), documents counted from ``key``.  SUCCESSORS: training counts (v, w, n) for each shard that v is
    cut over; elsewhere (v, w) is counted by the tokens themselves."""
    batch_of = _record_batches(ROW)

    def run(batches):
        words = vocabulary.value
        key = TaskContext.get().partitionId() << 40
        held, size, begin = [], 0, key

        def block(shard, kind, data):
            return batch_of(1, shard=[shard], kind=[kind], key=[begin], block=[data])

        def rows():
            d, u, v, w = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            for shard, data in _by_shard(words.home(u, v, w), v, d, u, v, w):
                yield block(shard, TOKENS, data)
            often = np.flatnonzero((words.cuts_of(v) > 1) & (d & 1 > 0))
            if len(often):
                names, place = np.unique(w[often], return_inverse=True)
                pairs, n = np.unique(v[often] * len(names) + place, return_counts=True)
                bv, bw = pairs // len(names), names[pairs % len(names)]
                cuts = words.cuts_of(bv)
                for cut in range(int(cuts.max())):
                    k = cuts > cut
                    for shard, data in _by_shard(words.shard(bv[k], np.full(int(k.sum()), cut)), bv[k], bv[k], bw[k], n[k]):
                        yield block(shard, SUCCESSORS, data)

        for batch in sliced(batches, 2, SLICE_TEXTS, SLICE_BYTES):
            seq, doc, v, u = _sequence([tokens(t) for t in batch.column(2).to_pylist()], words.ids)
            n = batch.num_rows
            inside = seq < len(words.counts)
            place = np.where(inside, seq, 0)
            log_uni = np.where(inside, words.log_uni[place], 0.0)
            number = key + np.arange(n)
            yield batch_of(
                n, shard=number % words.shards, kind=np.full(n, DOCUMENT), key=number, doc_id=batch.column(0),
                held_out=batch.column(1), n_tokens=np.bincount(doc, minlength=n),
                n_known=np.bincount(doc, weights=inside & (words.counts[place] > 0), minlength=n).astype(np.int64),
                base=np.bincount(doc, weights=log_uni, minlength=n),
                score=np.bincount(doc, weights=np.where(v < 0, log_uni, 0.0), minlength=n))
            train = ~batch.column(1).to_numpy(zero_copy_only=False)
            k = (v >= 0) | ~inside
            held.append((((key - begin + doc) * 2 + train[doc])[k], u[k], v[k], seq[k]))
            key += n
            size += int(k.sum())
            if size > FLUSH:
                yield from rows()
                size, begin = 0, key
        if size:
            yield from rows()

    rows = docs.select(F.col(id_col).cast("long"), held_out(id_col), F.col(text).cast("string"))
    return rows.mapInArrow(releasing(run), ROW)


ANSWER = ("kind int, key long, block binary, name long, a double, b double, doc_id long, held_out boolean, n_tokens long, "
          "n_known long, base double, score double")


def answers(blocks: DataFrame, vocabulary) -> DataFrame:
    """Rows of ANSWER, written.  DOCUMENT rows as they came; TOKENS: a block of (document, bits of the sum of its words in
    memory); SUCCESSORS: each token whose word is not in memory, with P(w | u, v) = a + b * P(w)."""
    batch_of = _record_batches(ANSWER)

    def run(batches):
        words, held, begins, more = vocabulary.value, [], [], []
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            whole = batch.filter(pa.array(kinds == DOCUMENT))
            if whole.num_rows:
                same = ("kind", "key", "doc_id", "held_out", "n_tokens", "n_known", "base", "score")
                yield batch_of(whole.num_rows, **{c: whole.column(c) for c in same})
            for i in np.flatnonzero(kinds != DOCUMENT).tolist():
                data = batch.column("block")[i].as_py()
                if kinds[i] == SUCCESSORS:
                    more.append(_unpacked(data, 3))
                else:
                    begins.append(batch.column("key")[i].as_py())
                    held.append(data)
        if not held:
            return
        none = [np.zeros(0, np.int64)] * 3
        counts = [np.concatenate(c) for c in zip(none, *more, strict=True)]
        train, opened, size = [], [], 0
        for data in held:
            block = _unpacked(data, 4)
            d, u, v, w = block
            k = (d & 1 > 0) & (v >= 0)
            train.append((v[k], u[k], w[k]))
            size += len(d)
            if size <= PER_SHARD:
                opened.append(block)  # up to a shard's usual number of tokens; later blocks are opened again
        columns = [np.concatenate(c) for c in zip(*train, strict=True)]
        train.clear()
        shard = Shard(build_shard(*columns, counts, words))
        columns.clear()
        at = 0
        while at < len(held):
            # blocks are scored together, up to about a shard's usual number of tokens
            group, size = [], 0
            while at + len(group) < len(held) and size < PER_SHARD:
                i = at + len(group)
                group.append(opened[i] if i < len(opened) else _unpacked(held[i], 4))
                size += len(group[-1][0])
            _, u, v, w = (np.concatenate(c) for c in zip(*group, strict=True))
            a, b = shard.score(u, v, w)
            inside = w < len(words.uni)
            log_p = np.where(a > -np.inf, a, b + words.log_uni[np.where(inside, w, 0)])
            end = 0
            for i, (d, _, _, name) in enumerate(group):
                part, d, begin = slice(end, end + len(d)), d >> 1, begins[at + i]
                end += len(d)
                mine, p = inside[part], log_p[part]
                total = np.bincount(d[mine], weights=p[mine])
                own = np.flatnonzero(np.bincount(d[mine]))
                if len(own):
                    yield batch_of(1, kind=[TOKENS], key=[begin], block=[_packed(own, total[own].view(np.int64))])
                rare = np.flatnonzero(~mine)
                if len(rare):
                    yield batch_of(len(rare), kind=np.full(len(rare), SUCCESSORS), key=begin + d[rare], name=name[rare],
                                   a=10.0 ** a[part][rare], b=10.0 ** b[part][rare])
            at += len(group)

    return written(blocks.repartitionById(vocabulary.value.shards, F.col("shard")).mapInArrow(releasing(run), ANSWER), "answers")


def _added(batches):
    """(key, score): the blocks of sums, added up per block of documents."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for key, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            d, bits = _unpacked(data.as_py(), 2)
            old = sums.get(key, np.zeros(0))
            new = np.zeros(max(len(old), int(d[-1]) + 1))
            new[:len(old)] = old
            new[d] += bits.view(np.float64)
            sums[key] = new
    for key, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array(key + np.arange(len(total))), pa.array(total)], ["key", "score"])


def score(docs: DataFrame, text: str = "text", id_col: str = "doc_id", per_shard: int = PER_SHARD,
          in_memory: int = IN_MEMORY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every document."""
    spark = docs.sparkSession
    with shuffles_dropped(spark):  # the counts and blocks that travelled are not read again
        table, total, distinct, texts = unigrams(docs, text, id_col)
        vocabulary = spark.sparkContext.broadcast(frequent_words(table, total, distinct, texts, per_shard, in_memory))
        rows = answers(token_blocks(docs, vocabulary, text, id_col), vocabulary)
    sums = rows.filter(F.col("kind") == TOKENS).select("key", "block").repartition("key")
    sums = sums.mapInArrow(releasing(_added), "key long, score double")
    words = table.filter(F.col("n") * 2**in_memory < total).select("name", "n")
    c = F.coalesce(F.col("n"), F.lit(0))
    uni = (c + 0.1) / F.lit(total + 0.1 * (distinct + 1))
    rare = (rows.filter(F.col("kind") == SUCCESSORS).select("key", "name", "a", "b").join(words, "name", "left")
            .groupBy("key").agg(F.sum((c > 0).cast("long")).alias("n_known"), F.sum(F.log10(uni)).alias("base"),
                                F.sum(F.log10(F.col("a") + F.col("b") * uni)).alias("score")))
    known = rows.filter(F.col("kind") == DOCUMENT).drop("kind", "block", "name", "a", "b")
    per = (known.unionByName(sums, allowMissingColumns=True).unionByName(rare, allowMissingColumns=True).groupBy("key")
           .agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
                *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "score")]))
    return per.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                      F.col("base").alias("base_score"), "score")
