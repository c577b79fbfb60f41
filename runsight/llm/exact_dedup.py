"""Exact deduplication by a heavy-hitter split (native: DataFrame functions only).

Texts are equal when their bytes are (a null text counts as empty); equality is decided by SHA-256.  The row
with the largest doc_id of a group stays.  Frequent digests, found by a Misra-Gries summary and verified by
exact counts, are broadcast (at most ``groups.SHARE`` rows) and removed map-side; the others are shuffled.

Defined results: null doc_ids lose against any other, a group of only null doc_ids keeps them; rows that
repeat both text and doc_id are marked alike by ``classify`` and leave one row in ``dedup``; an empty table
gives an empty result; other columns of any name are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsight.llm.common import free_name, written
from runsight.llm.groups import winners, with_groups


def digest(text):
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def classify(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text)).alias("text_sha256")), "digests")
    out = with_groups(rows, "text_sha256", "doc_id", F.max)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256")


def dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of equal texts, all columns kept.

    Rows of a heavy digest are filtered map-side by its winner's id; of the few that then remain one is
    kept per digest by a map-side combined aggregate.  Other rows go through one shuffle.
    """
    key, rn, tie = free_name(docs, "digest_key", "digest_rank", "digest_tie")
    cols = docs.columns
    rows = written(docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text)).alias(key)), "digests")
    won = winners(rows, key, "doc_id", F.max).select(F.col(key), F.col("keep_id").alias(rn))
    keyed = docs.withColumn(key, digest(F.col(text)))
    last = (keyed.join(F.broadcast(won), key).filter(F.col(id_col).eqNullSafe(F.col(rn)))
            .groupBy(key).agg(F.max_by(F.struct(*cols), F.xxhash64(*_hashable(docs))).alias(tie))
            .select(f"{tie}.*"))
    order = Window.partitionBy(key).orderBy(F.col(id_col).desc_nulls_last(), F.xxhash64(*_hashable(docs)))
    light = (keyed.join(F.broadcast(won.select(key)), key, "left_anti")
             .withColumn(rn, F.row_number().over(order)).filter(F.col(rn) == 1).select(cols))
    return light.unionByName(last)


def _hashable(docs: DataFrame) -> list[str]:
    return [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()
            and "variant" not in f.dataType.simpleString()]
