"""Personal data by patterns and a skip-chain conditional random field.

Base spans of four kinds (email, ip, card, phone) come from fixed patterns.  The field then labels the tokens
that hold a digit or "@" (all others are clamped to "none", as no kind can lie in them): neighbours in the
text are linked, and so are repeated or similar tokens anywhere in the document, each to its next occurrence
(linear in the tokens, never all pairs).  Tokens in base spans are clamped to their kind; loopy sum-product
messages carry the labels along both sorts of link.  Free tokens whose belief in a kind reaches BELIEF
become added spans, so a bare "555-2186" is found where the same document has "+1 (456) 555-2186".

Training is piecewise, on the base spans of about TRAIN_ROWS documents picked by a hash of doc_id (a
documented bound of the fit): token potentials by softmax regression on shapes, link potentials by the log
ratio of joint to independent label counts.  Executors send counts of shapes and label pairs only.

Defined results: a null or empty text has no spans (the hash of the empty string); added spans never overlap base
spans; a null doc_id stays null; rows that repeat are answered one by one; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TOKEN = re.compile(r"\S+")
SUSPECT = re.compile("[0-9@]")
TRAIN_ROWS = 20_000
BELIEF = 0.9
ROUNDS = 10
L = len(KINDS) + 1  # label 0: none
FIELDS = (7, 2, 5, 3, 2, 2, 2, 4)  # sizes of the shape's fields


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    """Matches of EMAIL, sought at each "@" so that plain words are not tried one by one."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found and found.end() > at:
            yield found.span()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind as listed, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def shape(token: str) -> tuple[int, ...]:
    """A token's shape: digits, "@", dots, hyphens, plus, brackets, letters, length; a few values each."""
    digits = sum(c in "0123456789" for c in token)
    return (int(np.searchsorted((0, 2, 5, 9, 12, 15), digits)), int("@" in token), min(token.count("."), 4),
            min(token.count("-"), 2), int("+" in token), int("(" in token or ")" in token),
            int(any(c.isalpha() for c in token)), int(np.searchsorted((4, 8, 16), len(token))))


def skip_key(token: str) -> str | None:
    """What repeated or similar tokens have in common: the last seven digits, else the bare lower-case token."""
    digits = re.sub("[^0-9]", "", token)
    if len(digits) >= 7 and not any(c.isalpha() for c in token):
        return digits[-7:]
    bare = token.lower().strip(".,;:!?()[]\"'")
    return bare if len(bare) >= 4 else None


class Graph:
    """Tokens and links of many documents: node arrays and an edge list."""

    def __init__(self):
        self.shapes, self.clamped, self.spans, self.doc = [], [], [], []
        self.near, self.skip, self.key = [], [], []

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        marks = sorted((a, b, k) for k, a, b in base)
        last_of: dict[str, int] = {}
        end, m = -2, 0
        for t in TOKEN.finditer(text):
            if not SUSPECT.search(t[0]):
                continue
            i = len(self.shapes)
            a, b = t.span()
            while m < len(marks) and marks[m][1] <= a:
                m += 1
            hit = next((k for x, y, k in marks[m:m + 4] if x < b and y > a), None)
            self.shapes.append(shape(t[0]))
            self.clamped.append(-1 if hit is None else hit + 1)
            self.spans.append((a, b))
            self.doc.append(doc)
            if end >= 0 and text[end:a].isspace() and a - end <= 2:
                self.near.append((i - 1, i))
            end = b
            key = skip_key(t[0])
            self.key.append(key)
            if key is not None:
                if key in last_of:
                    self.skip.append((last_of[key], i))
                last_of[key] = i


class Field:
    """Potentials of the field, in logs."""

    def __init__(self, unary: np.ndarray, near: np.ndarray, skip: np.ndarray):
        self.unary, self.near, self.skip = unary, near, skip

    @classmethod
    def trained(cls, counts: dict[tuple, float]) -> Field:
        """From ("u", shape..., label), ("n", a, b) and ("s", a, b) counts."""
        at = np.concatenate([[0], np.cumsum(FIELDS)])
        seen = [(k[1:-1], k[-1], c) for k, c in counts.items() if k[0] == "u"]
        w = np.zeros((at[-1] + 1, L))
        w[-1, 0] = 2.0  # before any evidence a token is none of the kinds
        if seen:
            x = np.zeros((len(seen), at[-1] + 1))
            y, n = np.zeros((len(seen), L)), np.array([c for _, _, c in seen], float)
            for r, (s, label, _) in enumerate(seen):
                x[r, [at[f] + v for f, v in enumerate(s)]] = 1
                x[r, -1], y[r, label] = 1, 1
            n /= n.sum()
            m, v = np.zeros_like(w), np.zeros_like(w)
            for k in range(1, 401):
                z = x @ w
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                g = x.T @ ((p - y) * n[:, None]) + 1e-5 * w
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                w = w - 0.05 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)

        def link(kind: str) -> np.ndarray:
            joint = np.full((L, L), 0.5) + 2 * np.eye(L)
            for k, c in counts.items():
                if k[0] == kind:
                    joint[k[1], k[2]] += c / 2
                    joint[k[2], k[1]] += c / 2
            joint /= joint.sum()
            return np.clip(np.log(joint / np.outer(joint.sum(1), joint.sum(0))), -4, 4)

        return cls(w, link("n"), link("s"))

    def beliefs(self, g: Graph) -> np.ndarray:
        """Label beliefs of all nodes after ROUNDS of damped sum-product messages."""
        at = np.concatenate([[0], np.cumsum(FIELDS)])[:-1]
        s = np.array(g.shapes)
        local = self.unary[s + at].sum(1) + self.unary[-1]
        clamp = np.array(g.clamped)
        fixed = clamp >= 0
        local[fixed] = -30.0
        local[fixed, clamp[fixed]] = 0.0
        edges = np.array(g.near + g.skip, dtype=np.int64).reshape(-1, 2)
        pair = np.concatenate([np.broadcast_to(self.near, (len(g.near), L, L)),
                               np.broadcast_to(self.skip, (len(g.skip), L, L))])
        src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        msg = np.zeros((len(src), L))
        total = local
        for _ in range(ROUNDS if len(src) else 0):
            out = total[src] - msg[back]
            out -= out.max(1, keepdims=True)
            new = np.log(np.einsum("ea,eab->eb", np.exp(out), np.exp(pair)) + 1e-30)
            new -= new.max(1, keepdims=True)
            msg = 0.5 * msg + 0.5 * new
            total = local.copy()
            np.add.at(total, dst, msg)
        p = np.exp(total - total.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def added(self, g: Graph, texts: dict[int, str]) -> dict[int, list[tuple[int, int, int]]]:
        """Spans of free tokens by document; neighbouring tokens of one kind make one span."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        if not g.shapes:
            return out
        p = self.beliefs(g)
        label = np.where((p.max(1) >= BELIEF) & (np.array(g.clamped) < 0), p.argmax(1), 0)
        joined = {j: i for i, j in g.near}
        open_at: dict[int, list[int]] = {}
        for i in np.flatnonzero(label).tolist():
            a, b = g.spans[i]
            text = texts[g.doc[i]]
            while b > a and text[b - 1] in ".,;:!?\"'":
                b -= 1
            while a < b and text[a] in ",;:\"'":
                a += 1
            prev = joined.get(i)
            if prev in open_at and label[prev] == label[i]:
                open_at[prev][2] = b
                open_at[i] = open_at.pop(prev)
            elif a < b:
                span = [int(label[i]) - 1, a, b]
                out.setdefault(g.doc[i], []).append(span)
                open_at[i] = span
        return {d: [tuple(s) for s in spans] for d, spans in out.items()}


def _suspects(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """(doc_id, text) with the text only where it has a digit or "@": nothing else can hold a span."""
    t = F.col(text)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.when(t.rlike("[0-9@]"), t).alias("text"))


def _counts(batches):
    """Counts of shapes by label and of label pairs by sort of link, as text keys.

    A free token that repeats one of a base span is unlabelled, not "none": it is left out.
    """
    seen: Counter = Counter()
    for batch in batches:
        g = Graph()
        for i, t in enumerate(batch.column(1).to_pylist()):
            if t:
                g.add(i, t, base_spans(t))
        label = [max(c, 0) for c in g.clamped]
        named = {(d, k) for d, k, c in zip(g.doc, g.key, g.clamped, strict=True) if c >= 0 and k is not None}
        known = [c >= 0 or (d, k) not in named for d, k, c in zip(g.doc, g.key, g.clamped, strict=True)]
        seen.update(("u", *s, y) for s, y, ok in zip(g.shapes, label, known, strict=True) if ok)
        seen.update(("n", label[a], label[b]) for a, b in g.near if known[a] and known[b])
        seen.update(("s", label[a], label[b]) for a, b in g.skip if known[a] and known[b])
    keys = list(seen)
    yield pa.RecordBatch.from_arrays([pa.array([" ".join(map(str, k)) for k in keys], pa.string()),
                                      pa.array([seen[k] for k in keys], pa.int64())], ["k", "n"])


def fit(docs: DataFrame, text: str = "text", id_col: str = "doc_id", max_rows: int = TRAIN_ROWS) -> Field:
    """Potentials from about ``max_rows`` documents; what reaches the driver is bounded by the number of shapes."""
    share = min(1.0, max_rows / max(docs.count(), 1))
    point = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000))
    rows = (_suspects(docs, text, id_col).filter(point < int(share * 1_000_000)).filter(F.col("text").isNotNull())
            .mapInArrow(_counts, "k string, n long").groupBy("k").agg(F.sum("n").alias("n")).collect())
    counts = {}
    for r in rows:
        kind, *rest = r["k"].split()
        counts[(kind, *map(int, rest))] = float(r["n"])
    return Field.trained(counts)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, field: Field, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for every document."""
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                texts = {i: t for i, t in enumerate(part.column(1).to_pylist()) if t}
                base = {i: base_spans(t) for i, t in texts.items()}
                g = Graph()
                for i, t in texts.items():
                    g.add(i, t, base[i])
                more = field.added(g, texts)
                rows = [[] for _ in names[1:]]
                for i in range(part.num_rows):
                    own = base.get(i, [])
                    line = [*[sum(k == j for k, _, _ in own) for j in range(len(KINDS))],
                            hashlib.sha256(_joined(own).encode()).hexdigest(),
                            _joined(sorted([*own, *more.get(i, [])])), len(more.get(i, []))]
                    for column, value in zip(rows, line, strict=True):
                        column.append(value)
                kinds = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, t) for c, t in zip(rows, kinds, strict=True)]], names)

    schema = ("doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
              + ", base_sha256 string, spans string, n_added long")
    return _suspects(docs, text, id_col).mapInArrow(run, schema)
