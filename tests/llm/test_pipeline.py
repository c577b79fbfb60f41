"""Pipeline stages against brute force, each on its own input."""

from collections import Counter

import pytest

import corpus_pipeline as P
from runsight.llm.common import table, written

from .test_methods import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        got = written(stage(spark, docs, SF), f"test_{name}")
        out.append((name, docs, got))
        docs = got
    return {name: (before, after) for name, before, after in out}


def test_columns_stay(steps):
    for name, (before, after) in steps.items():
        assert name == "pack" or (before.columns == after.columns and before.dtypes == after.dtypes)


def test_toxic_documents_go(spark, steps):
    before, after = steps["toxicity"]
    toxic = {r.doc_id for r in table(spark, SF, "labels").filter("toxic = 1").collect()}
    clean = {r.doc_id for r in table(spark, SF, "labels").filter("toxic = 0").collect()}
    kept = {r.doc_id for r in after.collect()}
    assert not kept & toxic and clean <= kept
    assert kept <= {r.doc_id for r in before.collect()}


def test_exact_copies_go(steps):
    before, after = steps["exact_dedup"]
    last = {}
    for r in before.collect():
        last[r.text or ""] = max(r.doc_id, last.get(r.text or "", -1))
    assert sorted(r.doc_id for r in after.collect()) == sorted(last.values())


def test_near_copies_go(steps):
    before, after = steps["near_dedup"]
    want = brute_components([(r.doc_id, r.text or "") for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, c in want.items() if i == c)


def test_mix_repeats_whole_rows(steps):
    before, after = steps["mix_sources"]
    rows, n = {r.doc_id: tuple(r) for r in before.collect()}, Counter()
    for r in after.collect():
        assert tuple(r) == rows[r.doc_id]
        n[r.doc_id] += 1
    assert max(n.values()) <= 3


def test_pack_holds_all(steps):
    before, after = steps["pack"]
    n = Counter(r.doc_id for r in before.collect())
    total = Counter()
    for r in after.collect():
        total[r.doc_id, r.doc_tokens] += r.length
    assert {(i, t): c for (i, t), c in total.items()} == {(i, t): n[i] * t for (i, t) in total} and {i for i, _ in total} == set(n)
