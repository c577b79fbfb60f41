"""Language filters, word runs and vector codes against brute force and on odd rows."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from runsight.llm import langid, periods, vectors
from runsight.llm.queries import QUERIES
from runsight.llm.suffixtree import Extensions

SF = "/root/testdata/sf0.001"


def naive_runs(s, min_length, min_power):
    """(start, length, smallest period) of all maximal periodic stretches, by start and period."""
    best = {}
    for q in range(1, len(s) // min_power + 1):
        k = 0
        while k < len(s) - q:
            a = k
            while k < len(s) - q and s[k] == s[k + q]:
                k += 1
            if k - a + q >= max(min_length, min_power * q) and k > a:
                best.setdefault((a, k - a + q), q)
            k += k == a
    return sorted(((a, n, q) for (a, n), q in best.items()), key=lambda r: (r[0], r[2]))


def test_common_extensions():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 40):
        for k in (1, 2, 5):
            s = rng.integers(1, k + 1, n)
            e = Extensions(s)
            assert sorted(range(n + 1), key=lambda i: s[i:].tolist()) == np.argsort(e.rank).tolist()
            i, j = (x.ravel() for x in np.meshgrid(np.arange(n + 1), np.arange(n + 1)))
            i, j = i[i != j], j[i != j]
            want = [next((d for d in range(n - max(a, b)) if s[a + d] != s[b + d]), n - max(a, b)) for a, b in zip(i, j)]
            assert e.common(i, j).tolist() == want


@pytest.mark.parametrize("limits", [(2, 2), (6, 4)])
def test_runs_against_brute_force(limits):
    rng = random.Random(3)
    for _ in range(400):
        n, k = rng.randint(0, 60), rng.randint(1, 4)
        s = [rng.randint(1, k) for _ in range(n)]
        if rng.random() < 0.4:
            a, p = rng.randint(0, 8), rng.randint(1, 6)
            s = [s[i] if i < a else s[min(a + (i - a) % p, n - 1)] for i in range(n)]
        got = periods.runs_of(np.array(s, np.int64), *limits).tolist()
        assert [tuple(r) for r in got] == naive_runs(s, *limits)


def test_periodic_runs_whole_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    some = 0
    for i, t in texts.items():
        w, h = t.encode().split(), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = naive_runs(w, 6, 4)
        gone = {k for a, m, p in runs for k in range(a + p, a + m)}
        r = got[i]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{m},{p}\n" for a, m, p in runs).encode()).hexdigest()
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        if runs:
            some += 1
            a, m, p = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (a, m, p, 1000 * m // p)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert some > 5


def test_periods_odd_rows(spark, odd, none):
    got = periods.find(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(r["doc_id"] for r in odd.collect())
    by = {r.doc_id: r for r in got}
    assert all(by[i].runs == [] and by[i].collapsed == "" for i in (4, 5, 6)) and by[7].collapsed == "one"
    assert by[12].collapsed == "x" * 50_000
    assert periods.find(none).count() == 0 and periods.digests(periods.find(none)).count() == 0
    far = spark.createDataFrame([(1, "a b " * 30_000 + "c"), (1, "la la la la la"), (None, "x y\x0b\n" * 4)],
                                "doc_id long, text string")
    runs = [[tuple(x) for x in r.runs] for r in periods.find(far).collect()]
    assert runs == [[(0, 60_000, 2)], [], [(0, 8, 2)]]
    made = far.select(periods.made_periodic(F.col("doc_id"), F.col("text")).alias("t")).collect()
    assert made[1].t == "la la la la la" and made[2].t == "x y\x0b\n" * 4


def brute_codes(x, k, parts, rounds):
    """Codes, errors and tables by comparing each part with each entry."""
    width = x.shape[1] // parts
    x = x.reshape(len(x), parts, width)
    books = [x[:k, p].copy() for p in range(parts)]

    def nearest(p):
        d = ((x[:, p, None] - books[p][None]) ** 2).sum(-1)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        for p in range(parts):
            c, _ = nearest(p)
            for e in np.unique(c):
                books[p][e] = x[c == e, p].sum(0) // (c == e).sum()
    both = [nearest(p) for p in range(parts)]
    return np.stack([c for c, _ in both], 1), sum(d for _, d in both), books


def test_orchard_search_is_exact():
    rng = np.random.default_rng(5)
    for k, width, high in ((1, 3, 9), (2, 1, 4), (16, 2, 5), (64, 4, 300)):  # few values: many ties
        tables = [rng.integers(-high, high, (k, width)) for _ in range(3)]
        books = vectors.Codebooks(tables)
        x = rng.integers(-high, high, (500, 3 * width))
        entry, gap = books.search(x)
        for p, t in enumerate(tables):
            d = ((x[:, None, p * width:(p + 1) * width] - t[None]) ** 2).sum(-1)
            assert (entry[:, p] == d.argmin(1)).all() and (gap[:, p] == d.min(1)).all()


def test_vector_codes_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = sorted(rows.collect(), key=lambda r: r.vec_id)
    x = np.floor(256 * np.array([r.embedding for r in data], np.float64)).astype(np.int64)
    code, error, books = brute_codes(x, 64, 16, 2)
    by_label = defaultdict(int)
    for r, e in zip(data, error.tolist()):
        by_label[r.label] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for c in b.ravel().tolist()).encode()).hexdigest()
    got = {r.vec_id: r for r in QUERIES["op13_orchard_codes"](spark, SF).collect()}
    assert len(got) == len(data)
    for r, c, e in zip(data, code.tolist(), error.tolist()):
        o = got[r.vec_id]
        assert (o.code, o.error, o.label_error, o.codebooks_sha256) == (
            "".join(f"{v:02x}" for v in c), e, by_label[r.label], sha)


def test_vector_odd_rows(spark):
    nan, inf = math.nan, math.inf
    good = [(i, [float(i % 5), -float(i), 0.5, 2.0], i % 2 or None, "x") for i in range(40)]
    odd = [(100, None, 1, "x"), (101, [1.0, None, 1.0, 1.0], 1, "x"), (102, [nan] * 4, 1, "x"), (103, [inf] * 4, 1, "x"),
           (104, [], 1, "x"), (105, [1.0] * 3, 1, "x"), (None, [1.0] * 4, 7, "x"), (3, [9.0] * 4, 7, None),
           (3, [9.0] * 4, 7, None), (106, [1e30, -1e30, 0.0, 0.0], 7, "x")]
    rows = spark.createDataFrame(good + odd, "vec_id long, embedding array<float>, label int, code string").repartition(3)
    got = vectors.compressed(rows, parts=2, entries=8).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted([*map(str, range(40)), "None", "3", "3", "106"])
    again = vectors.compressed(rows.repartition(7), parts=2, entries=8).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sums = defaultdict(int)
    for r in got:
        sums[r.label] += r.error
    assert all(r.label_error == sums[r.label] for r in got)
    assert vectors.compressed(rows.limit(0)).count() == 0
    few = vectors.compressed(rows.filter("vec_id < 3"), parts=2, entries=64).collect()
    assert [r.error for r in few] == [0, 0, 0, 0, 0][:len(few)]


def test_vector_decode(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = vectors.whole_numbers(rows)
    books = vectors.fit(x)
    codes = vectors.encode(x, books)
    gap = (vectors.decode(codes, books).withColumnRenamed("x", "y").join(x, "vec_id")
           .select("error", F.aggregate(F.zip_with("x", "y", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"),
                                        lambda s, d: s + d).alias("gap")).collect())
    assert len(gap) == x.count() and all(r.error == r.gap for r in gap)


def test_filter_names_all_languages():
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (3000, 50, 700, 1, 0, 900, 10, 20, 40)]
    sets[1] = np.concatenate([sets[1], sets[0][:500]])
    f = langid.Filter([f"l{i}" for i in range(9)], sets)
    for i, keys in enumerate(sets):  # never a missed member, also of the ninth language
        assert (f.languages(keys)[:, i // 8] >> (i % 8) & 1).all()
    other = rng.integers(0, 2**63, 200_000).astype(np.uint64)
    mask = f.languages(other)
    for i in range(9):
        assert abs((mask[:, i // 8] >> (i % 8) & 1).mean() - f.false_yes[i]) < 0.002 + f.false_yes[i] / 4


def test_counts_are_corrected():
    """A crowded filter, corrected, comes near the exact counts; an ample one equals them."""
    alphabet = [chr(0x4E00 + i) for i in range(5000)]  # many letters: few n-grams come twice
    words = ["".join(random.Random(i).choices(alphabet, k=5)) for i in range(600)]
    text = " ".join(words)
    known = langid.ngrams(langid.characters([" ".join(words[:300])])[0], 4)[1]
    exact = sum(int(np.isin(langid.ngrams(langid.characters([text])[0], o)[1], known).sum()) for o in langid.ORDERS)
    ample = langid.Filter(["a", "b"], [known, known[:1]], room=4096)
    assert abs(ample.counts([text])[0][0, 0] - exact) < 1
    tight = langid.Filter(["a", "b"], [known, known[:1]], room=2)
    assert tight.false_yes[0] > 0.03 and abs(tight.counts([text])[0][0, 0] - exact) < 0.1 * exact


def test_long_texts_are_read_in_blocks(monkeypatch):
    texts = ["der die das und " * 50, None, "the and of " * 80, "1234 !!", "x"]
    keys = [langid.ngrams(langid.characters([t])[0], 3)[1] for t in (texts[0], texts[2])]
    f = langid.Filter(["de", "en"], keys)
    whole = f.counts(texts)[0]
    monkeypatch.setattr(langid, "BLOCK", 37)
    assert np.allclose(whole, f.counts(texts)[0])
    assert f.predict(texts)[0] == ["de", "und", "en", "und", "de"]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    want = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.predict(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(got) == len(want) and sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.98 * len(held)
    blind = langid.predict(docs.withColumns({"lang": F.lit("zz"), "source": F.lit(None)}), model).collect()
    assert sorted(map(str, blind)) == sorted(map(str, got))


def test_language_odd_rows(spark, odd, none):
    model = langid.fit(odd)
    got = langid.predict(odd, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r["doc_id"] for r in odd.collect())
    assert {r.lang_pred for r in got if r.doc_id in (4, 5, 6)} == {"und"}
    assert {r.lang_pred for r in got if r.doc_id in (1, 8, 13)} == {"en"}
    assert langid.predict(none, model).count() == 0
    blank = langid.fit(none)
    assert {(r.lang_pred, r.score) for r in langid.predict(odd, blank).collect()} == {("und", 0.0)}


def test_written_shuffles_are_dropped(spark):
    """Inside shuffles_dropped a write leaves no shuffle behind, and the setting is as before afterwards."""
    from runsight.llm.common import shuffles_dropped, written
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, env = spark.conf.get(name), spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def blocks():
        kept = env.blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while kept.hasNext():
            names.add(kept.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    had = blocks()
    with shuffles_dropped(spark):
        df = written(spark.range(10_000).repartition(7, "id").mapInArrow(lambda batches: batches, "id long"), "dropped")
    for _ in range(50):  # removal is asked for at the end of the write and carried out in the background
        if not blocks() - had:
            break
        time.sleep(0.1)
    assert not blocks() - had and df.count() == 10_000 and spark.conf.get(name) == before
