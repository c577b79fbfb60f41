"""Toxicity categories by classifier chains.

The categories are predicted one after the other by linear (logistic) models on the words of a text and the
probabilities of the categories before.  A later model is trained with out-of-fold probabilities, so it sees the
earlier models as wrong as they are on new text.  The last category is the label itself; the ones before are
the labelled texts that hold a term of the category.

Training: at most about TRAIN_ROWS labelled documents, picked by a hash of doc_id (a documented bound of the
fit; scoring reads every document whole).  Executors count and select the features (words and their first 4
and 5 bytes); the driver gets only the selected features' positions in the bounded sample.

Defined results: a text without words (or null) has no features; without labels of both kinds nothing is toxic and
all probabilities are 0; labels with a null doc_id or label are ignored, repeated ones count once (toxic wins);
an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.llm.common import releasing, sliced, written

TRAIN_ROWS = 8000
MAX_FEATURES = 1024
MIN_DOCS = 4
FOLDS = 3
#: Texts and bytes that are scored together; a longer text is scored alone.
SLICE_TEXTS, SLICE_BYTES = 512, 4_000_000
#: Terms that place a toxic text in a category; parameters, in chain order.
CATEGORIES = {
    "insult": ("idiot", "moron", "stupid", "clown", "fool", "dumb"),
    "contempt": ("loser", "pathetic", "worthless", "useless"),
    "disgust": ("scum", "trash", "disgusting", "garbage", "vermin", "filthy"),
}
_FOLD_CASE = bytes(c + 32 if 65 <= c <= 90 else (32 if c < 128 and not chr(c).isalnum() else c) for c in range(256))


def features(text: str | None) -> set[bytes]:
    """Words with ASCII case folded and ASCII punctuation dropped, and their prefixes marked with a dash."""
    words = set((text or "").encode().translate(_FOLD_CASE).split())
    return words | {w[:4] + b"-" for w in words} | {w[:5] + b"-" for w in words}


class Sparse:
    """Rows of feature positions; all values are 1."""

    def __init__(self, rows: list):
        self.n = len(rows)
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.col = np.concatenate([np.asarray(r, np.int64) for r in rows]) if sizes.sum() else np.zeros(0, np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def t_dot(self, r: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.col, weights=r[self.row], minlength=width)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_linear(x: Sparse, extra: np.ndarray, y: np.ndarray, width: int, use: np.ndarray, rounds: int = 300,
               l2: float = 1e-4, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights of a logistic model (words; extra columns and, last, the intercept) on the rows in ``use``."""
    dense = np.hstack([extra, np.ones((x.n, 1))])
    w, v = np.zeros(width), np.zeros(dense.shape[1])
    theta = np.concatenate([w, v])
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    n = max(int(use.sum()), 1)
    for k in range(1, rounds + 1):
        p = sigmoid(x.dot(theta[:width]) + dense @ theta[width:])
        r = np.where(use, p - y, 0.0) / n
        g = np.concatenate([x.t_dot(r, width), dense.T @ r]) + l2 * theta
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** k)) / (np.sqrt(s / (1 - 0.999 ** k)) + 1e-8)
    return theta[:width], theta[width:]


class Chain:
    """The fitted chain; ``names`` in order, the last is the label's."""

    def __init__(self, names, vocabulary: dict[bytes, int], models, threshold: float):
        self.names, self.vocabulary, self.models, self.threshold = names, vocabulary, models, threshold

    def positions(self, text: str | None) -> list[int]:
        known = self.vocabulary
        return [known[f] for f in features(text) if f in known]

    def predict(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities, one column a category."""
        out = np.zeros((len(texts), len(self.names)))
        if self.models and texts:
            x = Sparse([self.positions(t) for t in texts])
            for k, (w, v) in enumerate(self.models):
                out[:, k] = sigmoid(x.dot(w) + out[:, :k] @ v[:-1] + v[-1])
        return out


def fit_chain(rows: list, y: np.ndarray, fold: np.ndarray, names: list[str], vocabulary: dict[bytes, int]) -> Chain:
    """Chain over the label columns of ``y``; ``rows`` are feature positions, ``fold`` the fold of each row."""
    x, width = Sparse(rows), len(vocabulary)
    held = np.zeros((x.n, 0))
    models = []
    for k in range(y.shape[1]):
        models.append(fit_linear(x, held, y[:, k], width, np.ones(x.n, bool)))
        p = np.zeros(x.n)
        for f in range(FOLDS):
            w, v = fit_linear(x, held, y[:, k], width, fold != f)
            p = np.where(fold == f, sigmoid(x.dot(w) + held @ v[:-1] + v[-1]), p)
        held = np.hstack([held, p[:, None]])
    return Chain(names, vocabulary, models, best_threshold(held[:, -1], y[:, -1]))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the out-of-fold probabilities, 0.05 to 0.95, that give the best F1."""
    cuts = np.unique(np.concatenate([[0.05, 0.95], p[(p > 0.05) & (p < 0.95)]]))
    score = []
    for c in cuts:
        hit = p >= c
        score.append(2 * (hit & (y == 1)).sum() / max(hit.sum() + (y == 1).sum(), 1))
    score = np.round(np.array(score), 12)
    best = cuts[score == score.max()]
    return float((best[0] + best[-1]) / 2)


def training_sample(docs: DataFrame, labels: DataFrame, text: str, id_col: str, label: str,
                    max_rows: int) -> DataFrame:
    """(doc_id, text, label, fold) of at most about ``max_rows`` labelled documents, written."""
    named = (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label).cast("int").alias("label")))
    share = min(1.0, max_rows / max(labels.count(), 1))
    point = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000))
    picked = written(named.filter(point < int(share * 1_000_000)), "toxic_labels")
    return written(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).join(picked, "doc_id")
                   .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(FOLDS)).cast("int")), "toxic_train")


def _count(batches):
    """Documents with each feature, by label, combined per task."""
    of = (Counter(), Counter())
    for batch in sliced(batches, 0, SLICE_TEXTS, SLICE_BYTES):
        for t, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            of[int(y > 0)].update(features(t))
    for y, c in enumerate(of):
        names = list(c)
        for i in range(0, len(names), 50_000):
            part = names[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([y] * len(part), pa.int32()),
                                              pa.array([c[f] for f in part], pa.int64())], ["f", "y", "n"])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic",
        max_rows: int = TRAIN_ROWS) -> Chain:
    """Fit the chain on the labelled documents."""
    names = [*CATEGORIES, label]
    train = training_sample(docs, labels, text, id_col, label, max_rows)
    size = {r["y"]: r["n"] for r in train.groupBy((F.col("label") > 0).cast("int").alias("y"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return Chain(names, {}, [], 0.5)
    share = size[1] / (size[0] + size[1])
    n1 = F.coalesce(F.sum(F.when(F.col("y") == 1, F.col("n"))), F.lit(0))
    counted = (train.select("text", "label").mapInArrow(_count, "f binary, y int, n long")
               .groupBy("f").agg(n1.alias("n1"), F.sum("n").alias("n")).filter(F.col("n") >= MIN_DOCS))
    expected = F.col("n") * share
    chi = (F.col("n1") - expected) * (F.col("n1") - expected) / expected
    chosen = counted.orderBy(chi.desc(), "f").limit(MAX_FEATURES).select("f").collect()
    vocabulary = {bytes(r["f"]): i for i, r in enumerate(chosen)}
    lookup = Chain(names, vocabulary, [], 0.5)

    def rows(batches):
        for batch in sliced(batches, 0, SLICE_TEXTS, SLICE_BYTES):
            texts = batch.column("text").to_pylist()
            found = [features(t) for t in texts]
            ys = [[int(y > 0 and any(w.encode() in f for w in terms)) for terms in CATEGORIES.values()] + [int(y > 0)]
                  for f, y in zip(found, batch.column("label").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lookup.positions(t) for t in texts], pa.list_(pa.int32())),
                 pa.array(ys, pa.list_(pa.int32())), batch.column("fold")], ["x", "y", "fold"])

    got = train.orderBy("doc_id").select("text", "label", "fold").mapInArrow(
        rows, "x array<int>, y array<int>, fold int").toPandas()
    return fit_chain(list(got["x"]), np.array(got["y"].tolist(), float), got["fold"].to_numpy(), names, vocabulary)


def score(docs: DataFrame, chain: Chain, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, a probability for each category (p_...) and toxic for every document."""
    names = [f"p_{c}" for c in chain.names]

    def run(batches):
        for batch in sliced(batches, 1, SLICE_TEXTS, SLICE_BYTES):
            p = chain.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(p[:, k]) for k in range(len(names))],
                 pa.array(p[:, -1] >= chain.threshold)], ["doc_id", *names, "toxic"])

    schema = "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", toxic boolean"
    return docs.select(F.col(id_col).cast("long"), F.col(text).cast("string")).mapInArrow(releasing(run), schema)


def drop_toxic(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns kept."""
    at = docs.columns.index(text)

    def run(batches):
        for batch in sliced(batches, at, SLICE_TEXTS, SLICE_BYTES):
            p = chain.predict(batch.column(at).to_pylist())
            yield batch.filter(pa.array(p[:, -1] < chain.threshold))

    return docs.mapInArrow(releasing(run), docs.schema)
