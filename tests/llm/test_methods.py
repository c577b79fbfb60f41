"""The methods' parts against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from runsight.llm import exact_dedup, groups, lm, minhash, mixing, packing, pii, suffix, toxicity
from runsight.llm.common import written
from runsight.llm.components import components
from runsight.llm.eliasfano import EliasFano, mapped_arrays, pack_arrays

from .conftest import sentence

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def fold(text):
    return text.encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()


def test_heavy_keys_are_split(spark):
    rows = written(spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), (F.col("id") / 2).cast("long").cast("string"))).alias("key")), "t")
    won = groups.winners(rows, "key", "id", F.max).collect()
    assert [(r.key, r.keep_id, r.group_size) for r in won] == [("hot", 29_997, 10_000)]
    got = groups.with_groups(rows, "key", "id").collect()
    size = Counter(r.key for r in got)
    assert all(r.group_size == size[r.key] for r in got) and len(got) == 30_000


def test_heavy_dedup(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "copy").otherwise(
        F.col("id").cast("string")).alias("text"), F.lit(1).alias("keep_id"))
    got = exact_dedup.dedup(docs)
    assert got.columns == docs.columns and got.count() == 2501
    assert got.filter("text = 'copy'").first().doc_id == 4998


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (10, 1000), (5000, 70_000), (2000, 10**12), (100, 90)):
        v = np.sort(rng.integers(0, top, n))
        e = EliasFano(mapped_arrays(pack_arrays(EliasFano.build(v, top))))
        if n:
            assert (e.access(np.arange(n)) == v).all()
        x = np.concatenate([v, rng.integers(0, top, 1000)]).astype(np.uint64)
        want = [int(np.searchsorted(v, k)) if k in set(v.tolist()) else -1 for k in x.tolist()]
        assert e.find(x).tolist() == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == top(x) for x in root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(seed, groups_, members, edits):
    rng = random.Random(seed)
    out = []
    for _ in range(groups_):
        base = sentence(rng, 80).split()
        for _ in range(members):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = sentence(rng, 1)
            out.append(" ".join(w))
    rng.shuffle(out)
    return list(enumerate(out))


def brute_components(texts):
    sets = {i: set(zip(w, w[1:], strict=False)) if len(w := fold(t)) > 1 else set(w) for i, t in texts}
    root = {i: i for i, _ in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("node", [512, 6])
def test_minhash_matches_brute_force(spark, monkeypatch, node):
    monkeypatch.setattr(minhash, "MORE_LEVELS", 2)
    monkeypatch.setattr(minhash.leaves, "__defaults__", (node,))
    rows = near_copies(node, 12, 14, 10)
    got = {r.doc_id: r.component_id for r in minhash.classify(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == brute_components(rows)


def test_chosen_paths_reach_the_recall():
    rng = np.random.default_rng(5)
    found, depth = 0, 4
    trees = minhash.tree_count(depth)
    for _ in range(300):
        a = rng.integers(0, 2**32, minhash.WIDTH, dtype=np.uint64)
        b = np.where(rng.random(minhash.WIDTH) < 0.8, a, a + np.uint64(1))
        sig = np.stack([a, b])
        rows = np.tile(np.arange(2), trees)
        path = minhash.mixed(np.repeat(np.arange(1, trees + 1, dtype=np.uint64) * minhash._BASE, 2))
        for _ in range(depth):
            rows, path = minhash.step(rows, path, sig)
        found += bool(set(path[rows == 0].tolist()) & set(path[rows == 1].tolist()))
    assert found >= 299


def test_recall_holds_when_nodes_branch_on(spark):
    """Many documents with half of their values in common, in nodes too large: pairs at the threshold still meet."""
    rng = np.random.default_rng(11)
    n = 700
    one = rng.integers(0, 2, (n, minhash.WIDTH))
    two = np.where(rng.random((n, minhash.WIDTH)) < 0.6, one, rng.integers(0, 2, (n, minhash.WIDTH)))  # 0.8 agree
    sig = np.stack([one, two], 1).reshape(2 * n, -1).astype("<u4")
    reps = written(spark.createDataFrame([(i, i, s.tobytes()) for i, s in enumerate(sig)],
                                         "id long, component long, sig binary").repartition(4), "reps")
    leaf = minhash.leaves(reps, 2, minhash.tree_count(2), 12)
    met = (leaf.withColumn("pair", F.floor(F.col("id") / 2)).groupBy("node", "pair")
           .agg(F.countDistinct("id").alias("k")).filter("k = 2").select("pair").distinct().count())
    assert met >= n - 2


def repeated_words(texts):
    """Words of each text that lie in a run of 50 words found twice."""
    seen = defaultdict(list)
    for i, t in texts:
        w = fold(t)
        for k in range(len(w) - 49):
            seen[tuple(w[k:k + 50])].append((i, k))
    want = defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                want[i].update(range(k, k + 50))
    return want


def passage_rows(seed, n):
    rng = random.Random(seed)
    extra = [sentence(rng, 400) for _ in range(3)]
    return [(10_000 + i, " ".join([sentence(rng, 30), " ".join(extra[i % 3].split()[rng.randrange(200):][:rng.randint(45, 90)]),
                                   sentence(rng, 30)])) for i in range(n)]


def found_words(df):
    got = defaultdict(set)
    for r in df.collect():
        got[r.doc_id].update(range(r.start, r.end))
        assert r.n_words == r.end - r.start >= 50
    return got


def test_suffix_matches_brute_force(spark, docs, texts):
    more = passage_rows(2, 60)
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    assert found_words(suffix.passages(rows)) == repeated_words([*texts.items(), *more])


def test_suffix_over_many_tasks(spark):
    keys = {"spark.sql.shuffle.partitions": "150", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        for seed in (5, 6):
            rows = passage_rows(seed, 14)
            assert found_words(suffix.passages(spark.createDataFrame(rows, "doc_id long, text string"))) == repeated_words(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize(("in_memory", "per_shard"), [(20, 1 << 20), (9, 1 << 20), (11, 4000)])
def test_language_model(spark, docs, texts, in_memory, per_shard):
    """All n-grams that occur twice, whether their words are in memory or not and however the trie is cut."""
    got = {r.doc_id: r for r in lm.score(docs, in_memory=in_memory, per_shard=per_shard).collect()}
    tokens = {i: [*fold(t), None] for i, t in texts.items()}
    train = [w for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 10]
    uni = Counter(t for w in train for t in w)
    n, v = sum(uni.values()), len(uni)
    two = Counter(p for w in train for p in zip(w, w[1:], strict=False))
    three = Counter(p for w in train for p in zip(w, w[1:], w[2:], strict=False))
    every = two
    two = {k: c for k, c in two.items() if c >= 2}
    three = {k: c for k, c in three.items() if c >= 2}
    left1, left2 = defaultdict(lambda: 1.0), defaultdict(lambda: 1.0)
    for (a, _), c in two.items():
        left1[a] -= (c - 0.75) / uni[a]
    for (a, b, _), c in three.items():
        left2[a, b] -= (c - 0.75) / every[a, b]

    def p1(w):
        return (uni[w] + 0.1) / (n + 0.1 * (v + 1))

    def p2(a, w):
        return max(two.get((a, w), 0) - 0.75, 0) / max(uni[a], 1) + left1[a] * p1(w)

    for i, w in tokens.items():
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0) and r.train_tokens == n
        assert r.n_tokens == len(w) and r.n_known == sum(uni[t] > 0 for t in w)
        assert r.base_score == pytest.approx(sum(log10(p1(t)) for t in w), rel=1e-9)
        total = 0.0
        for k, t in enumerate(w):
            if k > 1 and (w[k - 2], w[k - 1]) in left2:
                total += log10(max(three.get((w[k - 2], w[k - 1], t), 0) - 0.75, 0) / every[w[k - 2], w[k - 1]]
                               + left2[w[k - 2], w[k - 1]] * p2(w[k - 1], t))
            else:
                total += log10(p2(w[k - 1], t) if k else p1(t))
        assert r.score == pytest.approx(total, rel=0.02, abs=0.2)


def test_base_spans_match_plain_patterns():
    rng = random.Random(4)
    plain = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]
    parts = ["a@b.c", "x@y", "@", "@@", ".", "1.2.3.4", "256.1.1.1", "0001.2.3.4", "4465758382889437", "4465 7583 8288 9437", "+1 (456) 555-2186",
             "+12", " ", "  ", "-", "é", "word", "a.b-c+d@e-f.g.h", "1234567890123", "12.34", "+"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 9)))
        want = []
        for kind, p in enumerate(plain):
            for m in p.finditer(text):
                digits = re.sub("[^0-9]", "", m[0])
                ok = (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m[0].split("."))
                      or kind == 2 and 13 <= len(digits) <= 19 and pii.luhn(digits) or kind == 3 and 9 <= len(digits) <= 15)
                if ok:
                    want.append((kind, *m.span()))
        assert pii.base_spans(text) == want, text


def test_skip_links_add_repeated_tokens(spark):
    rows = [(i, f"word call +1 (456) 555-{2000 + i} today word word {i} and once more 555-{2000 + i} thanks") for i in range(60)]
    rows += [(100 + i, f"chapter {i} of 12 costs 3.50 or 4-5 a day in 19{i % 90 + 10}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs, pii.fit(docs)).collect()}
    assert all(r.n_added == 0 for i, r in got.items() if i >= 100)
    added = [r for i, r in got.items() if i < 60 and r.n_added]
    assert len(added) >= 50
    for r in added:
        text = dict(rows)[r.doc_id]
        _, start, end = r.spans.split(",")[-1].split(":")
        assert text[int(start):int(end)] == f"555-{2000 + r.doc_id}"


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    chain = toxicity.fit(docs, labels.filter(half))
    got = toxicity.score(docs.join(labels.filter(~half).select("doc_id"), "doc_id", "left_semi"), chain).join(
        labels.filter(~half).select("doc_id", F.col("toxic").alias("y")), "doc_id").collect()
    clean, toxic = [r for r in got if r.y == 0], [r for r in got if r.y == 1]
    assert sum(r.toxic for r in clean) <= 0.01 * len(clean)
    assert sum(r.toxic for r in toxic) >= 0.85 * len(toxic)


def test_targets_match_repeated_resharing(spark):
    sizes = {"a": 100, "b": 5, "c": 1000, None: 40, "d": 0}
    sized = spark.createDataFrame([(1, s, n, "0") for s, n in sizes.items()], "doc_id long, source string, size long, place string")
    got = {r.source: r.target for r in mixing.targets(sized).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    full, total = {}, sum(sizes.values())
    while True:
        free = {s for s in weight if s not in full}
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: 3.0 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    assert got == pytest.approx({**full, **share})


def test_mix_comes_near_its_targets(spark, docs):
    rows = mixing.taken(docs).collect()
    per = defaultdict(lambda: [0, 0.0])
    by_id = {r.doc_id: r.source for r in docs.collect()}
    for r in rows:
        per[by_id[r.doc_id]][0] += r.taken
        per[by_id[r.doc_id]][1] = r.target
    assert all(abs(t - g) <= 0.5 for t, g in per.values())


def test_slots_follow_the_golden_ratio(spark, docs):
    """Every slot but a source's only one belongs to the source its point falls on, ranks count up, blocks are even."""
    sized = mixing.sizes(docs)
    _, pieces = mixing.mix(sized, block=64)
    shares = {("n" if r.source is None else "s" + r.source): r for r in mixing.targets(sized).collect()}
    rows = pieces.groupBy("slot", "skey").agg(F.sum("words").alias("words")).collect()
    per = defaultdict(list)
    for r in rows:
        per[r.skey].append((r.slot, r.words))
    for key, slots in per.items():
        assert max(w for _, w in slots) - min(w for _, w in slots) <= 1
        s = shares[key]
        if len(slots) > 1:
            assert all(s.lo <= i % mixing.RING * mixing.GOLDEN % mixing.RING < s.hi for i, _ in slots)


def test_small_sources_beside_a_large_one(spark, monkeypatch):
    """Blocks of thousands of words: every small source still comes to its target, and no document of it is lost."""
    rng = random.Random(3)
    rows = [(i, sentence(rng, 2000), "a") for i in range(50)]
    rows += [(100 + 10 * k + i, sentence(rng, 20 + 30 * k), f"s{k}") for k in range(8) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing.mix, "__defaults__", (mixing.WEIGHTS, mixing.REPEAT, 5000))
    by_id, per = {i: s for i, _, s in rows}, defaultdict(lambda: [0, 0.0])
    for r in mixing.taken(docs).collect():
        per[by_id[r.doc_id]][0] += r.taken
        per[by_id[r.doc_id]][1] = r.target
    assert all(abs(t - g) <= 1 for t, g in per.values()), dict(per)
    kept = {r.doc_id for r in mixing.mixed_documents(docs).collect()}
    assert {i for i in by_id if i >= 100} <= kept


def test_packing_balances_cost():
    rng = np.random.default_rng(0)
    n = rng.integers(1, 2048, 800)
    out = packing.assign(n, 2048, 1.0, 1 / 2048)
    fill, parts = Counter(), Counter()
    for i, start, size, j in out:
        assert size > 0
        fill[j] += size
        parts[i] += size
    assert all(parts[i] == n[i] for i in range(len(n))) and max(fill.values()) <= 2048
    assert len(fill) == -(-n.sum() // 2048)
    assert packing.assign(np.zeros(0, int), 2048, 1, 1) == []
