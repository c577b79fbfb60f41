"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads the driver tables through
the fixtures module, so its work grows with the tables.  Timestamps leave as
ISO text (the sink format) so both engines print them the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from runsight.plans import oracle as O
from runsight.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def sink_text(df: DataFrame) -> DataFrame:
    """Format timestamp columns as ISO text; everything else is left alone."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The driver tables hold naive (wall-clock) timestamps; reading them as UTC keeps every
            # date part, window and deadline independent of the caller's zone.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return sink_text(fn(fx.Tables(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Importing the query modules fills the two dictionaries.
from runsight.plans import q_core, q_graph, q_incremental, q_io, q_ops, q_stream  # noqa: E402,F401
