"""Whole query results against plain runs of the same definition."""

import zlib

import numpy as np
import pytest

from runsight.llm import packing, toxicity
from runsight.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


def test_every_piece_against_the_tokenizer(spark):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = {r.doc_id: [*plain.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs}
    pieces = QUERIES["op10_pack"](spark, SF).collect()
    covered, rooms = {i: np.zeros(len(x), int) for i, x in ids.items()}, {}
    for p in pieces:
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own) and p.length > 0
        assert p.ids_crc32 == zlib.crc32(np.array(own[p.start:p.start + p.length], "<u4").tobytes())
        covered[p.doc_id][p.start:p.start + p.length] += 1
        rooms.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert all((c == 1).all() for c in covered.values())
    for parts in rooms.values():
        parts.sort()
        assert [a for a, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 2048
    tokens = sum(map(len, ids.values()))
    assert tokens >= 0.97 * 2048 * len(rooms)


def naive_assign(lengths, size, linear, quadratic):
    """Descending cost; each to the cheapest sequence that has room, None where there is none."""
    n_seq = -(-sum(lengths) // size)
    room, cost, out = [size] * n_seq, [0.0] * n_seq, {}
    for i in sorted(range(len(lengths)), key=lambda i: (-(linear * lengths[i] + quadratic * lengths[i] ** 2), i)):
        fits = [j for j in range(n_seq) if room[j] >= lengths[i]]
        out[i] = j = min(fits, key=lambda j: (cost[j], j)) if fits else None
        if j is not None:
            room[j] -= lengths[i]
            cost[j] += linear * lengths[i] + quadratic * lengths[i] ** 2
    return out


def test_assignment_is_the_greedy_one_by_cost():
    rng = np.random.default_rng(6)
    for _ in range(40):
        lengths = rng.integers(1, 100, rng.integers(1, 80))
        got = packing.assign(lengths, 100, 1.0, 0.02)
        want = naive_assign(lengths.tolist(), 100, 1.0, 0.02)
        whole = {i: j for i, at, n, j in got if n == lengths[i]}
        assert all(whole[i] == j for i, j in want.items() if j is not None)
        late = [i for i, j in want.items() if j is None]
        for i in late:  # cut over the rooms left, in order
            assert sorted(at for k, at, _, _ in got if k == i)[0] == 0
            assert sum(n for k, _, n, _ in got if k == i) == lengths[i]
        fill = np.zeros(-(-int(lengths.sum()) // 100), int)
        for _, _, n, j in got:
            fill[j] += n
        assert fill.max() <= 100 and fill.sum() == lengths.sum()


def dense_fit(x, y, rounds, l2, rate):
    """Plain Adam on the mean log loss with a dense matrix; the last column is the intercept."""
    theta = np.zeros(x.shape[1])
    m, s = theta.copy(), theta.copy()
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        g = x.T @ (p - y) / len(y) + l2 * theta
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** k)) / (np.sqrt(s / (1 - 0.999 ** k)) + 1e-8)
    return theta


@pytest.mark.parametrize("links", [1, 3])
def test_chain_against_dense_fits(links):
    """Each link sees the out-of-fold probabilities of the links before it, none of the links after it."""
    rng = np.random.default_rng(8)
    n, width = 90, 6
    x = (rng.random((n, width)) < 0.4).astype(float)
    y = np.stack([(x[:, k] + rng.random(n) > 0.9).astype(float) for k in range(links)], 1)
    fold = np.arange(n) % toxicity.FOLDS
    rows = [np.flatnonzero(r).tolist() for r in x]
    chain = toxicity.fit_chain(rows, y, fold, [f"c{k}" for k in range(links)], {bytes([i]): i for i in range(width)})
    held = np.zeros((n, 0))
    for k in range(links):
        full = np.hstack([x, held, np.ones((n, 1))])
        want = dense_fit(full, y[:, k], 300, 1e-4, 0.1)
        w, v = chain.models[k]
        assert np.allclose(np.concatenate([w, v]), want, atol=1e-6)
        p = np.zeros(n)
        for f in range(toxicity.FOLDS):
            t = dense_fit(full[fold != f], y[fold != f, k], 300, 1e-4, 0.1)
            p[fold == f] = 1 / (1 + np.exp(-np.clip(full[fold == f] @ t, -40, 40)))
        held = np.hstack([held, p[:, None]])


def naive_spans(rows, least=50):
    """(id, start, end) of the maximal stretches of words that lie in runs of ``least`` words that occur twice."""
    words = [(t or "").lower().split() for _, t in rows]
    seen = {}
    for r, w in enumerate(words):
        for i in range(len(w) - least + 1):
            seen.setdefault(tuple(w[i:i + least]), []).append((r, i))
    out = []
    for r, w in enumerate(words):
        mark = [False] * (len(w) + 1)
        for i in range(len(w) - least + 1):
            if len(seen[tuple(w[i:i + least])]) > 1:
                mark[i:i + least] = [True] * least
        start = None
        for i, m in enumerate(mark):
            if m and start is None:
                start = i
            elif not m and start is not None:
                out.append((rows[r][0], start, i))
                start = None
    return sorted(set(out), key=str)


def test_passages_of_repeated_and_null_ids(spark, monkeypatch):
    """One id with two texts, null ids as partners, a passage in a third of the rows; also with ends compared in steps."""
    import random

    from runsight.llm import suffix
    rng = random.Random(4)

    def text(n):
        return " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 400)) for _ in range(n))

    a, b, c = text(300), text(80), text(60)
    rows = [(1, a), (2, a), (1, text(60)), (3, b), (None, b), (1, text(70) + " " + b), (None, text(55)), (4, None), (5, "x")]
    rows += [(10 + k, text(rng.randint(0, 40)) + " " + c + " " + text(30)) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = naive_spans(rows)
    got = suffix.passages(docs).collect()
    assert sorted({(r.doc_id, r.start, r.end) for r in got}, key=str) == want
    monkeypatch.setattr(suffix, "ENDS", 6)
    again = suffix.passages(docs.repartition(7)).collect()
    assert sorted({(r.doc_id, r.start, r.end) for r in again}, key=str) == want
