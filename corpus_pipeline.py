"""A training-data pipeline over ``documents``: STAGES in order, each written and read again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs.
SQL cannot express the trained stage and the tokenizer, so there is no ORACLE_SQL; tests compare the stages
with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runsight.llm import exact_dedup, minhash, mixing, packing, toxicity
from runsight.llm.common import table, written
from runsight.llm.queries import tokenizer_path


def nontoxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the labels table, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each component of near duplicates stays."""
    return minhash.near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that sources come near their target weights."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    # the workers still hold what earlier stages used, so the encoder remembers fewer words than by default, and only
    # as long as its task runs
    return packing.pack(docs, tokenizer_path(), remembered=400_000, forget=True)


STAGES = [("toxicity", nontoxic), ("exact_dedup", exact), ("near_dedup", near), ("mix_sources", mix), ("pack", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
