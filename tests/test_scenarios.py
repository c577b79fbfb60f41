"""Scenario table for the cause classifier: ten cases per class plus boundaries,
evaluated in one DataFrame run (the reference calibrated on 50 scenarios)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from runsight.operators import fingerprint as FP

AS_OF = datetime(2026, 6, 1, 12, 0, 0)
METRIC_SCHEMA = ("job_name string, team string, verdict string, time_drift_score double, volume_drift_score double, "
                 "avg_duration double, avg_rows double, latest_duration double, latest_rows long, impact string, "
                 "sla_minutes double")


def row(job, td, vd, verdict="at_risk", avg_d=30.0, avg_r=1000.0, latest_d=None, latest_r=None, team="t"):
    latest_d = latest_d if latest_d is not None else round(avg_d + td * 3, 2)
    latest_r = latest_r if latest_r is not None else int(avg_r + vd * 100)
    return (job, team, verdict, td, vd, avg_d, avg_r, latest_d, latest_r, "high", 50.0)


def run(spark, rows, edges=(), infra=(0, 0), ci=()):
    m = spark.createDataFrame(rows, METRIC_SCHEMA)
    e = spark.createDataFrame(list(edges) or [("__none__", "__none2__")], "parent string, child string")
    i = spark.createDataFrame([infra], "storage_errors long, compute_errors long")
    c = spark.createDataFrame(list(ci) or [(AS_OF - timedelta(days=30), "success", "x")],
                              "created_at timestamp, conclusion string, name string")
    fp = FP.fingerprint(m, e, i, c, AS_OF)
    return {r["job_name"]: r for r in fp.collect()}


def test_data_quality_cases(spark):
    rows = [row(f"dq{i}", td, vd) for i, (td, vd) in enumerate(
        [(0.0, -2.0), (0.1, -1.6), (-0.4, -3.0), (0.49, -1.51), (0.2, -5.0), (-0.2, -2.5), (0.3, -1.7),
         (0.0, -1.9), (-0.49, -2.2), (0.1, -4.0)])]
    out = run(spark, rows)
    assert {r["fingerprint_type"] for r in out.values()} == {"data_quality_issue"}
    assert {r["evidence_score"] for r in out.values()} == {70}
    assert all(r["route_to_team"] == "ingestion_team" for r in out.values())


def test_data_quality_boundaries(spark):
    out = run(spark, [row("a", 0.5, -2.0), row("b", 0.0, -1.5)])
    assert out["a"]["fingerprint_type"] == "logic_bug"   # |z_time| must be < 0.5
    assert out["b"]["fingerprint_type"] == "logic_bug"   # z_vol must be < -1.5


def test_infrastructure_needs_unrelated_slow_and_errors(spark):
    rows = [row(f"s{i}", 2.0, 0.0) for i in range(4)]
    quiet = run(spark, rows)
    noisy = run(spark, rows, infra=(3, 0))
    assert {r["fingerprint_type"] for r in quiet.values()} == {"logic_bug"}
    assert {r["fingerprint_type"] for r in noisy.values()} == {"infrastructure_issue"}
    assert {r["evidence_score"] for r in noisy.values()} == {85}
    assert {r["unrelated_slow"] for r in noisy.values()} == {3}
    assert noisy["s0"]["statistical_evidence"].startswith("3 unrelated jobs slow")


def test_infrastructure_related_slow_jobs_do_not_count(spark):
    # a -> b -> c chain: all slow, all related; d alone unrelated
    rows = [row(j, 2.0, 0.0) for j in "abcd"]
    out = run(spark, rows, edges=[("a", "b"), ("b", "c")], infra=(1, 1))
    assert out["a"]["unrelated_slow"] == 1
    assert out["d"]["unrelated_slow"] == 3
    assert out["d"]["fingerprint_type"] == "infrastructure_issue"
    assert out["c"]["fingerprint_type"] == "cascade_failure"


def test_cascade_nearest_root_and_chain(spark):
    edges = [("r", "m"), ("m", "n"), ("n", "j")]
    rows = [row("r", 2.0, 0.0, verdict="safe", team="root_team"), row("m", 0.0, 0.0, verdict="safe"),
            row("n", 1.6, 0.0, verdict="safe", team="n_team"), row("j", 1.0, 0.0, verdict="breached")]
    out = run(spark, rows, edges=edges)
    j = out["j"]
    assert j["fingerprint_type"] == "cascade_failure" and j["evidence_score"] == 75
    assert j["cascade_root"] == "n"                  # the slow ancestor with most ancestors
    assert j["route_to_team"] == "n_team"
    assert j["statistical_evidence"] == "Root: n | Chain: n → j"


def test_cascade_ten_cases_and_diamond(spark):
    edges, rows = [], []
    for i in range(10):
        edges += [(f"p{i}", f"c{i}"), (f"p{i}", f"x{i}"), (f"x{i}", f"c{i}")]
        rows += [row(f"p{i}", 2.5, 0.0, verdict="safe"), row(f"x{i}", 0.0, 0.0, verdict="safe"),
                 row(f"c{i}", 1.0, 0.0)]
    out = run(spark, rows, edges=edges)
    assert all(out[f"c{i}"]["fingerprint_type"] == "cascade_failure" for i in range(10))
    assert out["c0"]["statistical_evidence"] == "Root: p0 | Chain: p0 → c0"   # shortest path through the diamond


def test_volume_spike_and_ratio_gap(spark):
    rows = [row(f"v{i}", 2.0, 2.0, avg_d=30.0, avg_r=1000.0, latest_d=30.0 * f, latest_r=int(1000 * f))
            for i, f in enumerate([1.5, 1.8, 2.0, 2.2, 2.5, 1.6, 1.9, 2.1, 2.4, 3.0])]
    rows.append(row("gap", 2.0, 2.0, avg_d=30.0, avg_r=1000.0, latest_d=60.0, latest_r=1300))   # gap 0.7
    rows.append(row("zero_rows", 2.0, 2.0, avg_d=30.0, avg_r=0.0, latest_d=60.0, latest_r=0))  # no division
    out = run(spark, rows)
    assert all(out[f"v{i}"]["fingerprint_type"] == "volume_spike" for i in range(10))
    assert out["gap"]["fingerprint_type"] == "logic_bug"
    assert out["zero_rows"]["fingerprint_type"] == "logic_bug"


def test_logic_bug_ci_bonus(spark):
    rows = [row("b", 2.0, 0.0)]
    base = run(spark, rows)["b"]
    near = run(spark, rows, ci=[(AS_OF - timedelta(minutes=10), "failure", "ci")])["b"]
    near_compute = run(spark, rows, infra=(0, 2), ci=[(AS_OF - timedelta(minutes=3), "failure", "ci")])["b"]
    far = run(spark, rows, ci=[(AS_OF - timedelta(minutes=30), "failure", "ci")])["b"]
    assert base["evidence_score"] == 40 and base["external_evidence"] == "none"
    assert near["evidence_score"] == 75 and near["external_evidence"] == "Failed CI run 10.0min ago"
    assert near_compute["evidence_score"] == 65
    assert far["evidence_score"] == 40                # 30 minutes is not inside the window
    assert base["statistical_evidence"] == "Isolated: time drift 2.0σ — dependencies healthy"


def test_no_anomalies_gives_empty(spark):
    assert run(spark, [row("s", 0.0, 0.0, verdict="safe")]) == {}


def test_calibration_total(spark):
    """Ten per class: every case lands in its class (score averages as documented)."""
    rows, expect = [], {}
    for i in range(10):
        rows.append(row(f"dq{i}", 0.1 * (i % 4), -1.6 - 0.1 * i)); expect[f"dq{i}"] = "data_quality_issue"
        rows.append(row(f"lb{i}", 1.6 + 0.1 * i, 0.0)); expect[f"lb{i}"] = "logic_bug"
    out = run(spark, rows)
    hits = sum(out[j]["fingerprint_type"] == c for j, c in expect.items())
    assert hits == len(expect)
