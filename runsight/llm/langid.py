"""Language identification by n-gram filters that answer with a bitmask of languages.

One Bloom filter serves all languages: its bit slices lie side by side, so that a position holds one bit a language.  Looking
an n-gram up reads a few positions and ANDs their masks: the result names all languages that contain the n-gram.  Over a
text the set bits are counted per language; a slice that is filled to f answers yes to a foreign n-gram with probability
f**HASHES, and the count is corrected for what that adds.  The language with the largest corrected count is the text's.

N-grams are of 1 to 4 characters (letters in lower case; other characters part words, and one blank before and after a
word counts as a character).  A language contains an n-gram that makes up at least RATE of its n-grams of that length and is not
much (RATIO) more frequent in another language.

Training: about TRAIN_TEXTS documents a language, picked by hash (a documented bound of the fit); executors count, and the
driver gets the n-grams above the rate, at most 4 / RATE a language whatever the table's size.  Prediction reads every text whole, in
blocks of characters; rows are independent, nothing is shuffled.

Defined results: a null text or one without a letter is "und" with score 0, so is every text if no language was learned; a
text that shares no n-gram with any language is of the largest one, score 0; ties go to the language with more training texts, then to
the smaller name; a null id hashes like an empty text; a null or blank lang teaches nothing; repeated rows count each; an
empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsight.llm.common import sliced, written

TRAIN_TEXTS = 4000
ORDERS = (1, 2, 3, 4)
RATE = 2.0 ** -15
RATIO = 8
HASHES = 3
#: Positions of the filter for each n-gram of the language with the most.
ROOM = 16
UNKNOWN = "und"
#: Texts and characters that are looked at together; a longer text is read in blocks.
SLICE_TEXTS, BLOCK = 512, 1 << 19
U64 = np.uint64
_MIX = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0xD6E8FEB86659FD93),
        U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB))


@cache
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a blank."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, number of the text of each, whether the text has a letter): blank-parted words, 0 before each text."""
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64) + 3
    raw = "".join(f"\0 {t or ''} " for t in texts).encode("utf-32-le")
    c = np.frombuffer(raw, np.uint32)
    starts = np.cumsum(sizes) - sizes
    c = _letters()[c]
    c[starts] = 0
    of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    letter = np.bincount(of[c > 32], minlength=len(texts)) > 0
    return c[keep], of[keep], letter


def ngrams(c: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, 64-bit key) of the n-grams of ``order`` inside words; the first and last character may be the blank."""
    n = len(c) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    letter = c > 32
    good = (c[:n] > 0) & (c[order - 1:] > 0)
    if order < 3:  # one letter at least
        good &= letter[:n] if order == 1 else letter[:n] | letter[1:]
    for k in range(1, order - 1):
        good &= letter[k:k + n]
    at = np.flatnonzero(good)
    h = np.full(len(at), order, U64)
    for k in range(order):
        h = (h ^ c[at + k]) * _MIX[0]
        h ^= h >> U64(31)
    return at, h


class Filter:
    """Bit-sliced Bloom filter: ``masks`` (positions, bytes of language bits)."""

    def __init__(self, names: list[str], keys: list[np.ndarray], hashes: int = HASHES, room: int = ROOM):
        self.names, self.hashes = names, hashes
        most = max((len(k) for k in keys), default=0)
        self.bits = max(6, int(np.ceil(np.log2(max(room * most, 1)))))
        self.masks = np.zeros((1 << self.bits, max(1, -(-len(names) // 8))), np.uint8)
        for i, k in enumerate(keys):
            for at in self.places(k):
                self.masks[at, i // 8] |= np.uint8(1 << i % 8)
        filled = np.array([(self.masks[:, i // 8] >> (i % 8) & 1).mean() for i in range(len(names))])
        #: Chance that a language says yes to an n-gram that it does not contain.
        self.false_yes = filled ** hashes

    def places(self, keys: np.ndarray):
        for j in range(1, self.hashes + 1):
            yield ((keys * _MIX[j]) >> U64(64 - self.bits)).astype(np.int64)

    def languages(self, keys: np.ndarray) -> np.ndarray:
        """The masks (n, bytes) of all languages that contain each n-gram."""
        out = None
        for at in self.places(keys):
            m = self.masks[at]
            out = m if out is None else out & m
        return out

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(corrected counts (texts, languages), whether the text has a letter)."""
        c, of, letter = characters(texts)
        n_texts, width = len(texts), self.masks.shape[1]
        yes = np.zeros((n_texts, width * 8))
        total = np.zeros(n_texts)
        bit = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(float)
        for begin in range(0, len(c), BLOCK):
            for order in ORDERS:
                at, keys = ngrams(c[begin:begin + BLOCK + order - 1], order)
                if not len(at):
                    continue
                own = of[begin + at]
                low = int(own[0])
                own = own - low
                span = int(own[-1]) + 1
                mask = self.languages(keys)
                for b in range(width):  # set bits by way of a histogram of the masks of each text
                    seen = np.bincount(own * 256 + mask[:, b], minlength=span * 256).reshape(span, 256)
                    yes[low:low + span, 8 * b:8 * b + 8] += seen @ bit
                    if b == 0:
                        total[low:low + span] += seen.sum(1)
        yes = yes[:, :len(self.names)]
        true = (yes - total[:, None] * self.false_yes) / np.maximum(1 - self.false_yes, 1e-9)
        return np.maximum(true, 0), letter

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, share of the corrected counts) of each text."""
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        true, letter = self.counts(texts)
        best = true.argmax(1)
        share = true[np.arange(len(texts)), best] / np.maximum(true.sum(1), 1e-9)
        names = [self.names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letter.tolist(), strict=True)]
        return names, np.where(letter, np.minimum(share, 1.0), 0.0)


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text leaves 1 by 3."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _counted(batches):
    """(lang, order, key, n), combined per slice."""
    for part in sliced(batches, 0, SLICE_TEXTS, BLOCK):
        c, of, _ = characters(part.column("text").to_pylist())
        lang = np.asarray(part.column("lang").to_pylist(), np.int64)
        for order in ORDERS:
            at, keys = ngrams(c, order)
            own = lang[of[at]]
            for k in np.unique(own).tolist():
                key, n = np.unique(keys[own == k], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), v), pa.int32()) for v in (k, order)]
                    + [pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["lang", "order", "key", "n"])


def fit(docs: DataFrame, text: str = "text", id_col: str = "doc_id", lang: str = "lang",
        train_texts: int = TRAIN_TEXTS) -> Filter:
    """The filter from the training documents that have a language."""
    named = (docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"),
                         F.col(lang).cast("string").alias("lang"))
             .filter(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & (F.trim("lang") != "")))
    sizes = [(r["lang"], r["n"]) for r in named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()]
    names = [x for x, _ in sorted(sizes, key=lambda r: (-r[1], r[0]))]
    if not names:
        return Filter([], [])
    part = F.create_map(*[F.lit(v) for x, n in sizes for v in (x, min(1.0, train_texts / n))])
    number = F.create_map(*[F.lit(v) for i, x in enumerate(names) for v in (x, i)])
    point = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1_000_000)) / 1_000_000
    picked = named.filter(point < part[F.col("lang")]).select("text", number[F.col("lang")].alias("lang"))
    counted = written(picked.mapInArrow(_counted, "lang int, order int, key long, n long")
                      .groupBy("lang", "order", "key").agg(F.sum("n").alias("n")), "lang_grams")
    total = {(r["lang"], r["order"]): r["n"] for r in
             counted.groupBy("lang", "order").agg(F.sum("n").alias("n")).collect()}
    if not total:
        return Filter(names, [np.zeros(0, U64)] * len(names))
    sums = F.create_map(*[v for (k, o), n in total.items() for v in (F.lit(k * 10 + o), F.lit(float(n)))])
    often = (counted.withColumn("rate", F.col("n") / sums[F.col("lang") * 10 + F.col("order")])
             .filter(F.col("rate") >= RATE))
    # one row an n-gram: at most one entry a language
    per = (often.groupBy("order", "key").agg(F.max("rate").alias("top"), F.collect_list(F.struct("lang", "rate")).alias("all"))
           .select("key", F.transform(F.filter("all", lambda x: x["rate"] * RATIO >= F.col("top")), lambda x: x["lang"])
                   .alias("langs"))).toArrow()
    key = per.column("key").to_numpy().view(U64)
    langs = per.column("langs").combine_chunks()
    lens = np.diff(langs.offsets.to_numpy())
    owner = np.repeat(key, lens)
    which = langs.flatten().to_numpy()
    return Filter(names, [owner[which == i] for i in range(len(names))])


def predict(docs: DataFrame, model: Filter, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    def run(batches):
        for part in sliced(batches, 2, SLICE_TEXTS, BLOCK):
            names, share = model.predict(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(share)],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")
