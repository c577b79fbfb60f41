"""Graph closure, as-of join, trailing windows, quality, reconciliation and deadlines
against brute force on small fixtures."""

from collections import deque
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from runsight.operators import deadlines as D
from runsight.operators import graph as G
from runsight.operators import quality as Q
from runsight.operators import recon as RC
from runsight.operators import velocity as VL
from runsight.operators.asof import asof_join


def bfs_closure(edges):
    adj = {}
    for p, c in edges:
        adj.setdefault(p, []).append(c)
    out = {}
    for s in {p for p, _ in edges}:
        dist, q = {s: 0}, deque([s])
        while q:
            u = q.popleft()
            for v in adj.get(u, []):
                if v not in dist:
                    dist[v] = dist[u] + 1
                    q.append(v)
        for v, d in dist.items():
            if v != s:
                out[(s, v)] = d
    return out


def test_closure_matches_bfs_chains_and_diamonds(spark):
    edges = [(f"n{k - 1}", f"n{k}") for k in range(1, 60) if k % 20 != 0]
    edges += [(f"n{k - 2}", f"n{k}") for k in range(2, 60) if k % 20 in (5, 11)]
    e = spark.createDataFrame(edges, "parent string, child string")
    got = {(r["anc"], r["job"]): r["hops"] for r in G.closure(e).collect()}
    assert got == bfs_closure(edges)


def test_closure_with_cycle_terminates_and_reports(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")]
    e = spark.createDataFrame(edges, "parent string, child string")
    got = {(r["anc"], r["job"]) for r in G.closure(e).collect()}
    assert ("a", "d") in got and ("a", "a") not in got
    assert {r["job_name"] for r in G.cycles(e).collect()} == {"a", "b", "c"}


def test_peeling_leaves_cycles_only(spark):
    """Two cycles with a bridge of two jobs between them, tails on both sides, and an acyclic part."""
    edges = [("a", "b"), ("b", "a"), ("b", "x"), ("x", "y"), ("y", "p"), ("p", "q"), ("q", "p"), ("t", "a"), ("q", "u")]
    edges += [(f"n{k - 1}", f"n{k}") for k in range(1, 12)]
    e = spark.createDataFrame(edges, "parent string, child string")
    assert {r["job_name"] for r in G.cycles(e).collect()} == {"a", "b", "p", "q"}
    assert G.cycles(e.filter(F.col("parent").startswith("n"))).count() == 0


def test_search_from_some_jobs_equals_the_closure(spark):
    edges = [(f"n{k - 1}", f"n{k}") for k in range(1, 60) if k % 20 != 0]
    edges += [(f"n{k - 2}", f"n{k}") for k in range(2, 60) if k % 20 in (5, 11)]
    e = spark.createDataFrame(edges, "parent string, child string")
    some = ["n7", "n19", "n40", "n58", "unknown"]
    got = {(r["anc"], r["job"]): r["hops"] for r in G.ancestors_of(
        spark.createDataFrame([(j,) for j in some], "job_name string"), e).collect()}
    want = {p: d for p, d in bfs_closure(edges).items() if p[1] in some} | {(j, j): 0 for j in some}
    assert got == want


def test_long_chain_is_found_and_read(spark):
    e = spark.createDataFrame([(f"n{k:04d}", f"n{k + 1:04d}") for k in range(1000)], "parent string, child string")
    c = G.ancestors_of(spark.createDataFrame([("n1000",)], "job_name string"), e)
    assert c.count() == 1001
    p = spark.createDataFrame([("n0000", "n1000"), ("n0990", "n1000"), ("n1000", "n0000")], "root string, job_name string")
    got = {r["root"]: (r["hops"], r["chain"]) for r in G.shortest_paths(p, c, e).collect()}
    assert got["n0000"] == (1000, G.ARROW.join(f"n{k:04d}" for k in range(1001)))
    assert got["n0990"] == (10, G.ARROW.join(f"n{k:04d}" for k in range(990, 1001)))
    assert got["n1000"] == (None, "n1000 → n0000")


def test_shortest_path_and_origin_root(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "d")]
    e = spark.createDataFrame(edges, "parent string, child string")
    c = G.closure(e)
    p = spark.createDataFrame([("a", "d"), ("b", "d")], "root string, job_name string")
    chains = {r["root"]: r["chain"] for r in G.shortest_paths(p, c).collect()}
    assert chains == {"a": "a → d", "b": "b → c → d"}
    slow = spark.createDataFrame([("a",), ("c",)], "job_name string")
    tgt = spark.createDataFrame([("d",)], "job_name string")
    counts = G.ancestor_counts(c)
    assert G.cascade_root(tgt, slow, c, counts, "nearest").first()["root"] == "c"
    assert G.cascade_root(tgt, slow, c, counts, "origin").first()["root"] == "a"


def test_asof_join_matches_merge_asof(spark):
    import random
    rnd = random.Random(7)
    t0 = datetime(2026, 1, 1)
    left = [(f"j{rnd.randint(0, 3)}", i, t0 + timedelta(minutes=rnd.randint(0, 60 * 24 * 5))) for i in range(400)]
    right = [(f"j{rnd.randint(0, 3)}", t0 + timedelta(minutes=rnd.randint(0, 60 * 24 * 5)), rnd.randint(0, 99))
             for _ in range(300)]
    right += [(left[0][0], left[0][2], 12345)]                     # equal time counts (at or before)
    L = spark.createDataFrame(left, "job string, id long, t timestamp")
    R = spark.createDataFrame(right, "job string, rt timestamp, v long")
    R = R.groupBy("job", "rt").agg(F.max("v").alias("v"))
    got = {r["id"]: r["v"] for r in asof_join(L, R, "job", "t", "rt", ["v"], target_rows=30)
           .collect()}
    adaptive = {r["id"]: r["v"] for r in asof_join(L, R, "job", "t", "rt", ["v"], target_rows=20).collect()}
    assert adaptive == got
    lp = pd.DataFrame(left, columns=["job", "id", "t"]).sort_values("t")
    rp = R.toPandas().rename(columns={"rt": "t"}).sort_values("t")
    lp["t"] = lp["t"].astype("datetime64[us]")
    rp["t"] = rp["t"].astype("datetime64[us]")
    exp = pd.merge_asof(lp, rp, on="t", by="job", direction="backward")
    want = {int(i): (None if pd.isna(v) else int(v)) for i, v in zip(exp["id"], exp["v"])}
    assert got == want


def test_velocity_trailing_matches_brute_force(spark):
    import random
    rnd = random.Random(3)
    t0 = datetime(2026, 1, 1)
    tx = [(rnd.randint(0, 5), i, 1.0, t0 + timedelta(seconds=rnd.randint(0, 7200))) for i in range(300)]
    df = spark.createDataFrame(tx, "account_id long, txn_id long, amount double, ts timestamp")
    got = {r["txn_id"]: r["trailing_count"] for r in VL.velocity_trailing(df, 5, 2).collect()}
    want = {}
    for a, i, _, t in tx:
        n = sum(1 for b, _, _, u in tx if b == a and t - timedelta(minutes=5) <= u <= t)
        if n > 2:
            want[i] = n
    assert got == want


def test_quality_report_cases(spark):
    rows = [("j", None if i % 5 == 0 else 1.0, "success") for i in range(40)]
    df = spark.createDataFrame(rows, "job_name string, duration_minutes double, status string")
    req = ("job_name", "duration_minutes", "status", "team")
    rep = Q.quality_report(df, required=req).first()
    assert rep["status"] == "FAIL"
    assert rep["issues"] == ["Schema drift — missing columns: team", "High null rate in duration_minutes: 20.0%"]
    assert rep["checks_passed"] == 1 and rep["checks_failed"] == 2
    empty = Q.quality_report(df.filter(F.lit(False)), required=req).first()
    assert empty["status"] == "WARM_UP" and empty["issues"] == [] and empty["checks_passed"] == 0
    small = Q.quality_report(df.limit(5).filter(F.col("duration_minutes").isNotNull()),
                             required=("job_name",)).first()
    assert small["status"] == "FAIL" and small["issues"][0].startswith("Low volume: only")
    many = spark.createDataFrame([(None, None, None)] * 20, "a string, b string, c string")
    m = Q.quality_report(many, required=("a", "b", "c", "d")).first()
    assert m["checks_passed"] == 0 and m["checks_failed"] == 4


def test_reconcile_one_sided_keys_and_tolerance(spark):
    src = spark.createDataFrame([("a",)] * 1000 + [("b",)] * 10, "k string")
    dst = spark.createDataFrame([("a",)] * 999 + [("c",)] * 3, "k string")
    r = {x["k"]: x for x in RC.reconcile(src, dst, ["k"], tol_pct=0.1).collect()}
    assert r["a"]["diff"] == 1 and r["a"]["diff_pct"] == 0.1 and r["a"]["status"] == "RECONCILED"
    assert r["b"]["destination_count"] == 0 and r["b"]["status"] == "MISMATCH"
    assert r["c"]["source_count"] == 0 and r["c"]["diff_pct"] == 0.0 and r["c"]["status"] == "MISMATCH"


def test_deadline_roll_and_buffers(spark):
    m = spark.createDataFrame([("j1", "breached"), ("j2", "safe")], "job_name string, verdict string")
    dl = spark.createDataFrame([("a", 19, 0, "UTC", "j2", 0), ("b", 23, 0, "UTC", "j2", 0),
                                ("c", 23, 59, "UTC", "j2", 0), ("c", 23, 59, "UTC", "j1", 1)],
                               "deadline_name string, hour int, minute int, tz string, job_name string, pos int")
    out = {r["deadline_name"]: r for r in D.deadline_risk(m, dl, "2001-11-04 22:45:00").collect()}
    assert out["a"]["buffer_minutes"] == 1215.0 and out["a"]["risk_level"] == "low"
    assert out["b"]["buffer_minutes"] == 15.0 and out["b"]["risk_level"] == "high"
    assert out["c"]["buffer_minutes"] == 74.0 and out["c"]["critical_jobs"] == "j1"
    assert out["c"]["risk_level"] == "high"


def test_shortest_path_with_ties_is_a_real_path(spark):
    # two shortest paths a-x-z-j and a-y-w-j: the smallest node per level (x, w) would not connect
    edges = [("a", "x"), ("x", "z"), ("z", "j"), ("a", "y"), ("y", "w"), ("w", "j")]
    e = spark.createDataFrame(edges, "parent string, child string")
    c = G.closure(e)
    p = spark.createDataFrame([("a", "j")], "root string, job_name string")
    assert G.shortest_paths(p, c).first()["chain"] == "a → x → z → j"


def test_deadline_without_jobs_stays(spark):
    dl = spark.createDataFrame([("a", 19, 0, "UTC", ["j1"]), ("idle", 12, 0, "UTC", [])],
                               "deadline_name string, hour int, minute int, tz string, jobs array<string>")
    m = spark.createDataFrame([("j1", "breached")], "job_name string, verdict string")
    out = {r["deadline_name"]: r for r in D.deadline_risk(m, D.explode_deadlines(dl), "2001-11-04 22:45:00").collect()}
    assert out["idle"]["critical_jobs"] == "" and out["idle"]["risk_level"] == "low"
    assert out["a"]["critical_jobs"] == "j1"


def test_first_resolution_wins(spark):
    from datetime import datetime

    from runsight.operators import incidents as K
    t0 = datetime(2026, 1, 1)
    inc = spark.createDataFrame([("j", t0, None)], "job_name string, detected_at timestamp, resolved_at timestamp")
    res = spark.createDataFrame([("j", t0, t0 + timedelta(minutes=9)), ("j", t0, t0 + timedelta(minutes=5))],
                                "job_name string, detected_at timestamp, resolved_at timestamp")
    got = K.resolve(inc, res).collect()
    assert [r["resolved_at"] for r in got] == [t0 + timedelta(minutes=5)]


def test_busy_ci_does_not_hide_a_failure(spark):
    from datetime import datetime

    from runsight.sources import signals as S
    now = datetime(2026, 1, 1, 12)
    ci = [(now - timedelta(minutes=8), "failure", "f")] + [(now - timedelta(minutes=7, seconds=-10 * i), "success", f"s{i}")
                                                           for i in range(30)]
    df = spark.createDataFrame(ci, "created_at timestamp, conclusion string, name string")
    assert S.nearest_failure(S.ci_window(df, now, 30), now).first()["ci_minutes"] == 8.0
