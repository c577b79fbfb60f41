"""Schemas of the input tables besides runs, and their readers (S9, S10, S14, S7, S8): no inference, bad values quarantined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: table -> (columns, those that a row cannot do without).
TABLES = {
    "registry": ("job_name string, team string, impact string, sla_minutes double, normal_rows bigint, "
                 "depends_on array<string>", ("job_name",)),
    "task_records": ("dag_id string, run_id string, start_date timestamp, end_date timestamp, state string", ("dag_id", "run_id")),
    "results": ("job_name string, completed_at timestamp, rows_processed bigint", ("job_name", "completed_at")),
    "infra_metrics": ("ts timestamp, metric string, value double", ("ts", "metric")),
    "ci_runs": ("created_at timestamp, conclusion string, name string", ("created_at", "conclusion")),
    "deadlines": ("deadline_name string, hour int, minute int, tz string, jobs array<string>", ("deadline_name", "hour", "minute")),
}
CORRUPT = "_corrupt_record"


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table][0])


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns of ``df`` in its types, and ``quarantined``; other columns are left out.

    A value that does not cast becomes NULL and flags its row, as does a missing needed value or a corrupt record; a
    column that is missing altogether is NULL, or an error where it is a needed one.
    """
    schema, needed = schema_of(table), TABLES[table][1]
    absent = [c for c in needed if c not in df.columns]
    if absent:
        raise ValueError(f"{table} lacks {', '.join(absent)}")
    bad, cols = F.lit(False), []
    for f in schema.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f.name).try_cast(f.dataType)
        bad = bad | (F.col(f.name).isNotNull() & value.isNull())
        cols.append(value.alias(f.name))
        if f.name in needed:
            bad = bad | value.isNull()
    if CORRUPT in df.columns:
        bad = bad | F.col(CORRUPT).isNotNull()
    return df.select(*cols, bad.alias("quarantined"))


def read(spark: SparkSession, table: str, path: str, form: str = "ndjson") -> DataFrame:
    """``table`` from files: "ndjson", "json" (arrays), or "parquet" with whatever types it has; see ``conform``."""
    if form == "parquet":
        return conform(spark.read.parquet(path), table)
    raw = (spark.read.schema(schema_of(table).add(CORRUPT, T.StringType())).option("multiLine", form == "json")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return conform(raw, table)


def read_good(spark: SparkSession, table: str, path: str, form: str = "ndjson") -> DataFrame:
    """The rows of ``read`` that are not quarantined."""
    return read(spark, table, path, form).filter(~F.col("quarantined")).drop("quarantined")
