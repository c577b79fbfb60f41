"""Odd rows and empty tables: every operator gives its defined result and leaves other columns alone."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest

from runsight.llm import exact_dedup, lm, minhash, mixing, packing, pii, quality, suffix, toxicity, warc
from runsight.llm.queries import tokenizer_path

LABELS = "doc_id long, quality int, toxic int"


def chain(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0), (7, 0, 0), (10, 1, 1), (10, 1, 0), (None, 1, 1),
                                    (8, 1, None)], LABELS)
    return toxicity.fit(docs, labels)


OPS = {
    "pii": lambda s, d: pii.find(d, pii.fit(d)),
    "exact": lambda s, d: exact_dedup.classify(d),
    "minhash": lambda s, d: minhash.classify(d),
    "quality": lambda s, d: quality.judge(d),
    "lm": lambda s, d: lm.score(d),
    "toxicity": lambda s, d: toxicity.score(d, chain(s, d)),
    "mixing": lambda s, d: mixing.taken(d),
}
KEEPING = {
    "exact": lambda s, d: exact_dedup.dedup(d),
    "minhash": lambda s, d: minhash.near_dedup(d),
    "toxicity": lambda s, d: toxicity.drop_toxic(d, chain(s, d)),
    "mixing": lambda s, d: mixing.mixed_documents(d),
}


@pytest.mark.parametrize("name", sorted(OPS))
def test_one_row_per_document(spark, odd, none, name):
    got = OPS[name](spark, odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in odd.collect())
    assert OPS[name](spark, none).count() == 0


@pytest.mark.parametrize("name", sorted(KEEPING))
def test_stages_keep_columns(spark, odd, none, name):
    got = KEEPING[name](spark, odd)
    assert got.columns == odd.columns and got.dtypes == odd.dtypes
    assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in odd.collect()}
    assert KEEPING[name](spark, none).count() == 0


def test_exact(spark, odd):
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.classify(odd).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[(4, empty)].keep_id == 5 and got[(4, empty)].group_size == 3 and got[(5, empty)].kept
    assert got[(None, empty)].keep_id == 5 and not got[(None, empty)].kept
    texts = [r["text"] or "" for r in exact_dedup.dedup(odd).collect()]
    assert sorted(texts) == sorted({r["text"] or "" for r in odd.collect()})


def test_exact_ids_all_null(spark):
    docs = spark.createDataFrame([(None, "a")] * 5 + [(None, "b")], "doc_id long, text string")
    assert sorted(r["text"] for r in exact_dedup.dedup(docs).collect()) == ["a", "b"]


def test_minhash(spark, odd):
    got = {r.doc_id: r for r in minhash.classify(odd).filter("doc_id is not null").collect()}
    assert got[3].component_id == 1 and got[2].component_id == 1 and got[9].component_id == 8
    assert got[4].n_shingles == got[5].n_shingles == got[6].n_shingles == 0
    assert all(got[i].component_id == i and got[i].kept for i in (4, 5, 6, 7, 12))
    assert got[7].n_shingles == 1 and got[59].component_id == 20


def test_quality(spark, odd):
    got = {r.doc_id: r for r in quality.judge(odd).collect()}
    assert got[4].n_words == 0 and got[4].base_failed and not got[4].kept and got[1].kept
    assert quality.judge(odd).filter("kept").filter("n_repeat_words >= 0").count() >= 3


def test_quality_rules_need_no_order(spark, odd):
    rows = quality.measures(odd.select("doc_id", "text"))
    rules = quality.default_rules()
    seen = [sorted(map(str, quality.cascade(rows, rules, "ok", order=o).select("doc_id", "ok").collect()))
            for o in (list(rules), list(rules)[::-1], quality.order_rules(rows.select("*"), rules))]
    assert seen[0] == seen[1] == seen[2]


def test_lm(spark, odd):
    got = {r.doc_id: r for r in lm.score(odd).filter("doc_id is not null").collect()}
    assert got[4].n_tokens == got[5].n_tokens == got[6].n_tokens == 1
    assert all(r.score == r.score and r.score < 0 for r in got.values())


def test_mixing(spark, odd):
    got = mixing.taken(odd).collect()
    assert all(r.taken <= 3 * r["size"] and r.target <= 3 * r.source_size for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken(odd.repartition(5)).collect()))


def test_packing(spark, odd, none):
    pieces = packing.pack(odd, tokenizer_path()).collect()
    assert packing.pack(none, tokenizer_path()).count() == 0
    by_seq = {}
    for p in pieces:
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(r["doc_id"] for r in odd.collect())


def test_encoder_matches_the_tokenizer():
    import numpy as np
    texts = ["a<|endoftext|>b <|startoftext|> x<|end", "É É ́x   y\x1cz\x0bq", "don't DON'T ... a.,b\r\n\tΣΑΣ İ σ, ς. Straße!", "",
             " ", "<|endoftext|>", ". , .. a. a, 1. 1.5, x!? été, été ǅ ª º ʰ K é́.", "<|endoftext|>. a's, it's. we'll! \xa0,"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        enc = packing.Encoder(public_tokenizers.path(name))
        want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert enc.by_word == (enc.light is not None) == (name[0] == "w")
        for light, stops, gap in ((enc.light, enc.stops, enc.gap), (None, enc.stops, enc.gap), (None, b"", None)):
            enc.light, enc.stops, enc.gap, enc.known, enc.before = light, stops, gap, {}, {}
            assert [np.frombuffer(b, "<u4").tolist() for b in enc(texts)] == want
        enc.before, enc.known = enc.known, {}
        assert [np.frombuffer(b, "<u4").tolist() for b in enc(texts)] == want


def test_suffix(spark, odd, none):
    got = suffix.passages(odd).collect()
    assert suffix.passages(none).count() == 0
    spans = {(r.doc_id, r.start, r.end) for r in got}
    assert {(1, 0, 120), (2, 0, 120), (8, 0, 30_000), (9, 0, 30_000), (10, 0, 121), (3, 6, 120)} <= spans
    assert not {4, 5, 6, 7, 11, 12, 13, 20} & {r.doc_id for r in got}


def test_warc(spark):
    body = "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhello é"
    pages = spark.createDataFrame(
        [(1, "http://a/b c\r\nX: y", body, 0), (2, None, body, 1), (3, "u", None, 2), (4, "u", "", 3), (None, "n", body, 4),
         (None, "n", "only", 5), (7, "t", "tie", 6), (7, "t", "tie", 7)], "page_id long, url string, html string, payload_digest int")
    got = sorted(warc.archive_pages(pages).collect(), key=str)
    assert len(got) == 8
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append((r.record_type, r.refers_to, r.payload_bytes))
    n = len(body.encode())
    assert by[1] == [("revisit", 2, n)] and by[2] == [("response", None, n)]
    assert by[3] == [("revisit", 4, 0)] and by[4] == [("response", None, 0)]
    assert by[7] == [("response", None, 3)] * 2
    assert sorted(by[None], key=str) == sorted([("revisit", 2, n), ("response", None, 4)], key=str)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_pii(spark, odd):
    got = {r.doc_id: r for r in pii.find(odd, pii.fit(odd)).collect()}
    assert got[4].base_sha256 == hashlib.sha256(b"").hexdigest() and got[4].spans == ""
    r = got[11]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 0, 0, 1)
    assert r.spans.startswith("email:5:13,phone:17:34")
