"""Cost-balanced packing of token sequences.

A document is its token ids and an end id.  Each full sequence length of it is a sequence of its own; the
rest is packed with the rests of the other documents of its block (the next BLOCK documents of the partition):
pieces in descending order of their estimated cost, linear * n + quadratic * n^2 of attention, each go to the
sequence of least cost so far that has room.  A block gets as many sequences as its tokens fill, so less than
one sequence of padding; pieces that fit nowhere whole are cut over the rooms left.

Work and memory follow the rows: a task holds one block.  Nothing is shuffled.  Sequence ids hold the
partition and a counter, so a task that runs again gives the same rows.

Defined results: a null text is empty (one piece, the end id); a null doc_id stays null; repeated rows are packed
one by one; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from math import ceil
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.llm.common import releasing, sliced

BLOCK = 4096
#: Words whose ids a worker remembers, twice: the older half is dropped when full.  Results do not depend on it.
REMEMBERED = 700_000
#: ASCII characters that may end a word without being a part of it.
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Texts and characters that are encoded together; a longer text is encoded alone.
SLICE_TEXTS, SLICE_CHARS = 1024, 4_000_000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes, for tokenizers that never join across blanks.

    Each blank-separated word is encoded once and remembered (folded in A-Z if the tokenizer does so itself).  New
    words are encoded in bulk: those of letters only, in the form that the tokenizer would give them, by its model
    alone, told apart by the model's mark of word ends; up to three signs of punctuation at the end are a part of their
    own; all others by the whole tokenizer, held apart by a special token.  Each short cut, and each such end, is used
    only if it agrees on PROBES; if words can't be told apart the texts are encoded whole.
    """

    PROBES = ("word", "in", "the", "été", "straße", "σοφός", "日本語", "naïveté", "ñandú", "don", "x", "zqxj")

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        fold = self._ids("A").tobytes() == self._ids("a").tobytes()
        self.table = bytes(c + 32 if fold and 65 <= c <= 90 else (32 if c in (9, 10, 13) else c) for c in range(256))
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.gap, self.gap_id = max(special.items(), key=lambda x: x[1]) if special else (None, None)
        self.marks = [m.encode() for m in special]
        apart = b"".join(self._ids(w).tobytes() for w in self.PROBES)
        self.by_word = self._ids("\n ".join(self.PROBES)).tobytes() == apart
        self.stops = PUNCTUATION if self.by_word else b""
        #: Ids of the runs of punctuation that were tried after words, None for those that change a word's ids.
        self.tails: dict[bytes, bytes | None] = {}
        self.light, suffix = None, getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix and fold:
            self.light = Tokenizer.from_file(path)
            self.light.normalizer = normalizers.Sequence([])
            self.light.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocabulary = self.light.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
            if b"".join(self._plain(list(self.PROBES))) != apart:
                self.light = None
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of words that need no normalising, by the model alone."""
        ids = np.array(self.light.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        return _parts(ids, np.flatnonzero(self.ends[ids]) + 1, 0)

    def _tail(self, word: bytes) -> int:
        """Length of the punctuation at the end of ``word`` that is encoded apart from what is before it, else 0."""
        head = word.rstrip(self.stops)
        n = len(word) - len(head)
        if not 0 < n <= 3 or not head or any(m in word for m in self.marks):
            return 0
        if not (head[-1:].isalnum() or (head[-1] > 127 and head.decode()[-1].isalpha())):
            return 0
        tail = word[-n:]
        if tail not in self.tails:
            own, end = self._ids(tail.decode()).tobytes(), tail.decode()
            want = b"".join(self._ids(w).tobytes() + own for w in self.PROBES)
            same = self._ids("\n ".join(w + end for w in self.PROBES)).tobytes() == want
            self.tails[tail] = own if same else None
        return n if self.tails[tail] is not None else 0

    def learn(self, words: list[bytes]) -> None:
        """Remember the ids of ``words``."""
        known, whole = self.known, []
        cut = [(w, n) for w in words if w[-1:] in self.stops and w and (n := self._tail(w))] if self.stops else []
        new = set(words).difference(w for w, _ in cut)
        new.update(w[:-n] for w, n in cut)
        new = [w for w in new if w and w not in known]
        if self.light is not None:
            text = [w.decode() for w in new]
            ok = [t.isalpha() and t == t.lower() and is_normalized("NFC", t) for t in text]
            plain = [t for t, y in zip(text, ok, strict=True) if y]
            if plain:
                known.update(zip([t.encode() for t in plain], self._plain(plain), strict=True))
            new = [w for w, y in zip(new, ok, strict=True) if not y]
        for w in new:
            if w and self.gap is not None and not any(m in w for m in self.marks):
                whole.append(w)
            else:
                known[w] = self._ids(w.decode()).tobytes()
        if whole:
            ids = self._ids(self.gap.join([w.decode() for w in whole]))
            known.update(zip(whole, _parts(ids, np.append(np.flatnonzero(ids == self.gap_id), len(ids)), 1), strict=True))
        known.update((w, known[w[:-n]] + self.tails[w[-n:]]) for w, n in cut)
        known[b""] = b""

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self._ids(t).tobytes() for t in texts]
        raw = pa.array([t.encode().translate(self.table) for t in texts], pa.binary())
        split = pc.split_pattern(raw, " ")
        coded = split.flatten().dictionary_encode()  # each different word is looked up once
        words, at = _values(coded.dictionary), coded.indices.to_numpy()
        if len(self.known) > self.remembered:
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        own = list(map(known.get, words))
        new = [w for w, ids in zip(words, own, strict=True) if ids is None]
        if before:
            known.update((w, before[w]) for w in new if w in before)
        self.learn([w for w in new if w not in before])
        if new:
            own = [known[w] if ids is None else ids for w, ids in zip(words, own, strict=True)]
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        starts = np.cumsum(sizes) - sizes
        n = sizes[at]
        ends = np.cumsum(n)
        place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[at] - (ends - n), n)
        ids = np.frombuffer(b"".join(own), "<u4")[place].tobytes()
        stop = np.concatenate([[0], ends])[split.offsets.to_numpy()] * 4
        return [ids[a:b] for a, b in zip(stop.tolist(), stop[1:].tolist(), strict=False)]


def _values(column: pa.Array) -> list[bytes]:
    """The values of a binary column without nulls."""
    stop = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].tolist()
    raw = column.buffers()[2].to_pybytes() if column.buffers()[2] else b""
    return [raw[a:b] for a, b in zip(stop, stop[1:], strict=False)]


def _parts(ids: np.ndarray, ends: np.ndarray, gap: int) -> list[bytes]:
    """Runs of ids that end before the positions ``ends``, ``gap`` ids apart."""
    raw, stop = ids.tobytes(), (ends * 4).tolist()
    return [raw[a:b] for a, b in zip([0, *[e + 4 * gap for e in stop[:-1]]], stop, strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """The worker's encoder for the vocabulary file ``path``."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].remembered = remembered
    return _ENCODERS[path]


def assign(lengths: np.ndarray, size: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """(piece, start in piece, length, sequence) for pieces shorter than ``size``, in order of assignment."""
    n_seq = ceil(int(lengths.sum()) / size)
    room, cost = np.full(n_seq, size), np.zeros(n_seq)
    price = linear * lengths + quadratic * lengths.astype(float) ** 2
    out, late = [], []
    for i in np.argsort(-price, kind="stable").tolist():
        n = int(lengths[i])
        j = int(np.argmin(np.where(room >= n, cost, np.inf)))
        if room[j] < n:
            late.append((i, n))
            continue
        out.append((i, 0, n, j))
        room[j] -= n
        cost[j] += price[i]
    gaps = iter(np.argsort(-room, kind="stable").tolist())
    j = next(gaps, None)
    for i, n in late:
        done = 0
        while done < n:
            while room[j] == 0:
                j = next(gaps)
            part = min(n - done, int(room[j]))
            out.append((i, done, part, j))
            room[j] -= part
            done += part
    return out


def pack(docs: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id", size: int = 2048,
         end_id: int = 1, linear: float = 1.0, quadratic: float = 1 / 2048, block: int = BLOCK,
         remembered: int = REMEMBERED, forget: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``forget``: a task leaves no words behind in its worker (less memory for what the worker does next, more time).
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        encode, end = encoder(tokenizer_path, remembered), np.array([end_id], "<u4").tobytes()
        base, used = TaskContext.get().partitionId() << 40, 0
        out: list[tuple] = []
        rests: list[tuple] = []

        def emit():
            rows = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * len(names))], names)
            out.clear()
            return rows

        def flush():
            nonlocal used
            fill: dict[int, int] = {}
            lengths = np.array([len(r[2]) // 4 for r in rests])
            for i, a, n, j in assign(lengths, size, linear, quadratic):
                doc, start, ids, total = rests[i]
                crc = zlib.crc32(ids[4 * a:4 * (a + n)])
                out.append((doc, start + a, n, crc, total, base + used + j, fill.get(j, 0)))
                fill[j] = fill.get(j, 0) + n
            used += ceil(int(lengths.sum()) / size)
            rests.clear()

        for part in sliced(batches, 1, SLICE_TEXTS, SLICE_CHARS):
            texts = [t or "" for t in part.column(1).to_pylist()]
            for doc, ids in zip(part.column(0).to_pylist(), encode(texts), strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total - size + 1, size):
                    out.append((doc, start, size, zlib.crc32(ids[4 * start:4 * (start + size)]), total,
                                base + used, 0))
                    used += 1
                if total % size:
                    start = total - total % size
                    rests.append((doc, start, ids[4 * start:], total))
                    if len(rests) >= block:
                        flush()
            if len(out) > 10_000:
                yield emit()
        if rests:
            flush()
        yield emit()
        if forget:
            encode.known, encode.before = {}, {}

    return docs.select(F.col(id_col).cast("long"), F.col(text).cast("string")).mapInArrow(
        releasing(run), SCHEMA)
