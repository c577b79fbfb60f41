"""Registered queries of the package: name -> (spark, sf_dir) -> DataFrame, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runsight.llm import (exact_dedup, langid, lm, minhash, mixing, packing, periods, pii, quality, suffix, toxicity,
                          vectors, warc)
from runsight.llm.common import table
from runsight.llm.oracle import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_pii(spark, sf_dir):
    """Personal data in every document: pattern spans and those that the field adds."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


@query
def op2_exact_dedup(spark, sf_dir):
    """Groups of equal texts, the largest doc_id stays."""
    return exact_dedup.classify(table(spark, sf_dir, "documents"))


@query
def op3_minhash_join(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return minhash.classify(table(spark, sf_dir, "documents"))


@query
def op4_quality_cascade(spark, sf_dir):
    """Base measures and the cascade's verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op5_sparse_suffix(spark, sf_dir):
    """Stretches of 50 words or more that occur again, in all documents."""
    return suffix.passages(table(spark, sf_dir, "documents"))


@query
def op6_warc_revisit(spark, sf_dir):
    """Pages written as deduplicated WARC archives and read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


@query
def op7_lm_score(spark, sf_dir):
    """Unigram and trie scores of all documents."""
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark, sf_dir):
    """Category probabilities and the verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op9_mix_sources(spark, sf_dir):
    """Words that the mix takes of every document."""
    return mixing.taken(table(spark, sf_dir, "documents"))


@query
def op10_pack(spark, sf_dir):
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op11_langid(spark, sf_dir):
    """Language of every document by bitmask n-gram filters."""
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op12_periodic_runs(spark, sf_dir):
    """Runs of repeated words in every document, a tenth of them made periodic first."""
    docs = table(spark, sf_dir, "documents")
    return periods.digests(periods.find(
        docs.select("doc_id", periods.made_periodic(F.col("doc_id"), F.col("text")).alias("text"))))


@query
def op13_orchard_codes(spark, sf_dir):
    """Codes of every sound vector, in hexadecimal."""
    found = vectors.compressed(table(spark, sf_dir, "embeddings"))
    digits = F.concat_ws("", F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    return found.select("vec_id", digits.alias("code"), "error", "label_error", "codebooks_sha256")


ORACLE = {k: v for k, v in SQL.items() if k in QUERIES}
