"""Gold tables in the catalog, and SQL table functions over them.

``publish`` names the current version of each published table; a later publication moves the name in one catalog step, so
SQL users see the old or the new table.  The functions take parameters and are inlined: their filters reach the scan.
They are the session's (SQL names table functions without a database) and read the database published last.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from runsight.operators.verdicts import URGENT
from runsight.sources import files as IO

DATABASE = "runsight"
_URGENT = ", ".join(f"'{v}'" for v in URGENT)
_CARD = "job_name STRING, latest_duration DOUBLE, sla_minutes DOUBLE, verdict STRING, priority_score DOUBLE"
_CARD_COLS = "job_name, latest_duration, sla_minutes, verdict, priority_score"

#: name -> (parameters, result columns, body); each reads gold_job_metrics.
FUNCTIONS = {
    "drilldown": ("job STRING", _CARD, f"SELECT {_CARD_COLS} FROM {{db}}.gold_job_metrics WHERE job_name = drilldown.job"),
    "urgent_jobs": ("", _CARD, f"SELECT {_CARD_COLS} FROM {{db}}.gold_job_metrics WHERE verdict IN ({_URGENT})"),
    "team_jobs": ("of STRING, least DOUBLE DEFAULT 0.0", _CARD,
                  f"SELECT {_CARD_COLS} FROM {{db}}.gold_job_metrics WHERE team = team_jobs.of "
                  "AND coalesce(priority_score, 0.0) >= team_jobs.least"),
}


def publish(spark: SparkSession, tables: dict[str, str], database: str = DATABASE) -> None:
    """Name the current version of each table (name -> path of ``replace_atomic``) and define the functions.

    A table whose columns have changed is defined anew; files are never touched.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path in tables.items():
        full, place = f"{database}.{name}", IO.current_folder(spark, path)
        now = spark.read.parquet(place).schema
        if spark.catalog.tableExists(full) and spark.table(full).schema != now:
            spark.sql(f"DROP TABLE {full}")
        if spark.catalog.tableExists(full):
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{place}'")
            spark.catalog.refreshTable(full)
        else:
            spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{place}'")
    if spark.catalog.tableExists(f"{database}.gold_job_metrics"):
        for name, (params, columns, body) in FUNCTIONS.items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS TABLE ({columns}) "
                      f"RETURN {body.format(db=database)}")
