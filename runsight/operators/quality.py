"""Table quality report.

Schema drift is a driver-side comparison of column names (metadata, not data);
row count and all null counts come from one aggregation pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import rnd

# Fixed values of the reference's check.
REQUIRED = ("job_name", "start_time", "duration_minutes", "status", "rows_processed", "team", "sla_minutes")
NULL_PCT, MIN_ROWS, N_CHECKS = 5.0, 10, 3


def null_rates(df: DataFrame, required=REQUIRED) -> DataFrame:
    """One row per present required column: null_pct (1 dp) over all rows."""
    present = [c for c in sorted(required) if c in df.columns]
    n = F.count(F.lit(1))
    row = df.agg(*[F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), n) .alias(c) for c in present])
    stack = ", ".join(f"'{c}', `{c}`" for c in present)
    return row.selectExpr(f"stack({len(present)}, {stack}) AS (column_name, null_frac)").select(
        "column_name", rnd(F.col("null_frac") * 100.0, 1).alias("null_pct"))


def _issues(df: DataFrame, required, null_pct: float, min_rows: int, keys: list[str]):
    present = [c for c in sorted(required) if c in df.columns]
    missing = sorted(set(required) - set(df.columns))
    n = F.count(F.lit(1))
    aggs = [n.alias("row_count")] + [F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in present]
    g = df.groupBy(*keys).agg(*aggs)
    msgs = []
    if missing:
        msgs.append(F.lit("Schema drift — missing columns: " + ", ".join(missing)))
    for c in present:
        pct = rnd(F.col(f"_n_{c}").cast("double") / F.col("row_count") * 100.0, 1)
        msgs.append(F.when(pct > null_pct, F.concat(F.lit(f"High null rate in {c}: "),
                                                     F.format_string("%.1f", pct), F.lit("%"))))
    msgs.append(F.when(F.col("row_count") < min_rows,
                       F.concat(F.lit("Low volume: only "), F.col("row_count").cast("string"),
                                F.lit(" rows (expected 30+ for healthy system)"))))
    issues = F.filter(F.array(*msgs), lambda x: x.isNotNull())
    return g, issues


def quality_report(df: DataFrame, required=REQUIRED, null_pct: float = NULL_PCT, min_rows: int = MIN_ROWS,
                   by: list[str] | None = None) -> DataFrame:
    """Q1: WARM_UP (no rows) / PASS / FAIL with counts and the issue list.

    ``by`` reports per group (e.g. per day) instead of over the whole table.
    checks_passed = 3 - issues, floored at 0.
    """
    keys = by or []
    g, issues = _issues(df, required, null_pct, min_rows, keys)
    out = g.select(*keys, "row_count", issues.alias("issues"))
    if not keys:
        # An empty table still yields one row: the warm-up report.
        out = out.select("row_count", F.when(F.col("row_count") > 0, F.col("issues"))
                         .otherwise(F.array().cast("array<string>")).alias("issues"))
    k = F.size("issues")
    status = (F.when(F.col("row_count") == 0, "WARM_UP").when(k > 0, "FAIL").otherwise("PASS"))
    return out.select(*keys, status.alias("status"), "row_count",
                      F.when(F.col("row_count") == 0, 0).otherwise(F.greatest(F.lit(0), F.lit(N_CHECKS) - k))
                      .alias("checks_passed"),
                      F.when(F.col("row_count") == 0, 0).otherwise(k).alias("checks_failed"), "issues")


# ---- types of raw records (Q2, S1) --------------------------------------------
#: The JSON type of each field of a run record.
RUN_TYPES = {"job_name": "string", "team": "string", "impact": "string", "sla_minutes": "number", "normal_rows": "integer",
             "cycle_number": "integer", "run_id": "string", "start_time": "string", "duration_minutes": "number",
             "rows_processed": "integer", "status": "string", "volume_multiplier": "number", "depends_on": "array"}
UNREADABLE = "unreadable"


def as_variant(lines: DataFrame, col: str = "value") -> DataFrame:
    """One ``record`` a JSON text, as it came and with its own types; NULL where the text is no JSON object."""
    v = F.try_parse_json(F.col(col))
    return lines.select(F.when(F.schema_of_variant(v).startswith("OBJECT<"), v).alias("record"))


def _json_type(v) -> Column:
    t = F.schema_of_variant(v)
    return (F.when(t == "VOID", "null").when(t == "BIGINT", "integer").when(t == "STRING", "string")
            .when(t == "BOOLEAN", "boolean").when(t.startswith("ARRAY"), "array").when(t.startswith("OBJECT"), "object")
            .otherwise("number"))


def type_report(records: DataFrame, expected: dict[str, str] = RUN_TYPES) -> DataFrame:
    """Per field and type found in the raw ``records``: expected_type (NULL: not expected), records, share_pct of all records, drift.

    A field drifts where its type is not the expected one (an integer is a number; null fits any type) or it is not expected.
    Texts that are no JSON object are counted in a row of their own, without a field, whose share is the rate of unreadable
    records.  An empty table gives no rows.  Counted on the map side; the total of records is a scalar subquery over those counts.
    """
    spark = records.sparkSession
    broken = F.col("record").isNull()
    one = records.withColumn("_record", F.when(broken, F.parse_json(F.lit("{}"))).otherwise(F.col("record")))
    each = one.lateralJoin(spark.tvf.variant_explode_outer(F.col("_record").outer()))
    # a record is counted once, at its first field (an empty or broken one has a single row without a field)
    found = (each.groupBy(F.col("key").alias("field"),
                          F.when(broken, UNREADABLE).when(F.col("key").isNotNull(), _json_type(F.col("value"))).alias("found_type"))
             .agg(F.count(F.lit(1)).alias("records"), F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("_first")))
    total = found.select(F.sum("_first")).scalar()
    want = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])[F.col("field")]
    fits = (F.col("found_type") == "null") | (F.col("found_type") == want) | ((want == "number") & (F.col("found_type") == "integer"))
    return (found.filter(F.col("found_type").isNotNull())
            .select("field", want.alias("expected_type"), "found_type", "records",
                    rnd(F.col("records").cast("double") / total * 100.0, 3).alias("share_pct"),
                    (~F.coalesce(fits, F.lit(False))).alias("drift")))


def merged_schema(records: DataFrame) -> DataFrame:
    """One row: the schema that fits all readable records."""
    return records.agg(F.schema_of_variant_agg("record").alias("schema"))
