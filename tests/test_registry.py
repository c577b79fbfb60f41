"""Contract checks: every registered query has an oracle; oracle pairs agree on small data."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
# Keys whose Spark form runs quickly at sf0.001; the full list runs in tools/oracle_check.py.
FAST = ["job_metrics", "gold_verdicts", "verdict_counts", "agg_latest", "agg_p95_exact", "agg_p95_approx",
        "replay_scores", "urgent_topk", "heatmap", "graph_closure", "cascade_chain", "fingerprint_noisy",
        "sla_health", "deadline_risk", "deadline_risk_tz", "incident_new_only", "mttr", "dq_report_by_day",
        "reconcile", "velocity_trailing", "daily_summary", "share_ranked", "extract_runs_newest",
        "asof_rows_processed", "silver_clean", "sink_atomic_replace", "stream_job_metrics", "stream_run_drift",
        "fingerprint_busy_ci", "volume_growth_undated", "replay_scores_undated", "incident_resolved", "incident_report", "view_fingerprints",
        "stream_dedupe", "stream_incidents", "stream_velocity_tumbling", "pipeline_end_to_end", "job_metrics_incremental",
        "incident_resolved_stored", "managed_metrics", "view_drilldown", "dq_report_types", "stream_velocity_trailing",
        "deadline_critical_jobs", "src_signals"]


def test_every_query_has_an_oracle():
    from runsight.plans.catalog import ORACLE, QUERIES
    assert set(E.oracle_sql()) <= set(E.queries())
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert missing == [], missing


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_oracle_pair(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_cols, d_rows = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 10
    assert {"job_name", "verdict", "priority_score"} <= set(df.columns)
