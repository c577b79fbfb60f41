"""Graph and fingerprint queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from runsight.operators import fingerprint as FP
from runsight.operators import graph as G
from runsight.operators import metrics as M
from runsight.plans import oracle as O
from runsight.plans.catalog import register
from runsight.sources import fixtures as fx
from runsight.sources import signals as S

GR = O.GRAPH


def _edges(t):
    return G.edges(fx.registry(t))


def _slow(m):
    return m.filter(F.coalesce("time_drift_score", F.lit(0.0)) > FP.SLOW_Z).select("job_name")


def _anomalous(m):
    return m.filter(F.col("verdict").isin(*FP.URGENT))


@register("registry_edges", O.with_(O.SUP, O.EDGES) + "SELECT parent, child FROM edges")
def q_registry_edges(t):
    """Edges of the registry graph."""
    return _edges(t)


@register("graph_closure", GR + "SELECT anc, job, hops FROM clo")
def q_graph_closure(t):
    """Transitive closure with fewest hops (path doubling)."""
    return G.closure(_edges(t))


@register("ancestor_counts", GR + """, nodes AS (SELECT job_name FROM sup)
  SELECT n.job_name, CAST(count(c.anc) AS BIGINT) AS n_ancestors FROM nodes n LEFT JOIN clo c ON c.job = n.job_name
  GROUP BY n.job_name""")
def q_ancestor_counts(t):
    """Ancestors per job, roots included with 0."""
    return G.ancestor_counts(G.closure(_edges(t)), G.nodes(fx.registry(t)))


FPB = O.with_rec(O.SUP, O.RUNS, O.metrics_cte(), O.EDGES, O.CLOSURE, O.SLOW)


@register("slow_ancestors", FPB + "SELECT c.job AS job_name, c.anc FROM clo c JOIN slow s ON s.job_name = c.anc "
          "WHERE c.job IN (SELECT job_name FROM an)")
def q_slow_ancestors(t):
    """Slow ancestors of each anomalous job."""
    m = gold_table(t)
    return G.slow_ancestors(_anomalous(m), _slow(m), _search(t, m))


@register("unrelated_slow", FPB + "SELECT job_name, unrelated_slow FROM unrel")
def q_unrelated_slow(t):
    """Slow jobs unrelated to each anomalous job, without pairing slow x slow."""
    m = gold_table(t)
    return G.unrelated_slow(_anomalous(m), _slow(m), _search(t, m))


@register("cascade_root", FPB + "SELECT job_name, root, slow_ancestors FROM roots")
def q_cascade_root(t):
    """Nearest slow ancestor (most ancestors) of each anomalous job."""
    m = gold_table(t)
    c = _search(t, m)
    return G.cascade_root(_anomalous(m), _slow(m), c, G.ancestor_counts(c))


@register("cascade_chain", FPB + """SELECT r.root, r.job_name, c.hops, ch.chain FROM roots r
  JOIN chains ch ON ch.job_name = r.job_name JOIN clo c ON c.anc = r.root AND c.job = r.job_name""")
def q_cascade_chain(t):
    """Shortest path from the cascade root to the job."""
    m = gold_table(t)
    c = _search(t, m)
    roots = G.cascade_root(_anomalous(m), _slow(m), c, G.ancestor_counts(c))
    return G.shortest_paths(roots.select("root", "job_name"), c, _edges(t))


@register("cascade_root_origin", FPB + """SELECT c.job AS job_name, arg_min(c.anc, (coalesce(cnt.n_anc, 0), c.anc)) AS root,
  count(*) AS slow_ancestors FROM clo c JOIN slow s ON s.job_name = c.anc LEFT JOIN cnt ON cnt.job = c.anc
  WHERE c.job IN (SELECT job_name FROM an) GROUP BY c.job""")
def q_cascade_root_origin(t):
    """G7 with the origin of the cascade: the slow ancestor with the fewest ancestors of its own."""
    m = gold_table(t)
    c = _search(t, m)
    return G.cascade_root(_anomalous(m), _slow(m), c, G.ancestor_counts(c), mode="origin")


@register("registry_cycles", "WITH RECURSIVE " + ", ".join((O.SUP, O.EDGES)) + """,
  wrong AS (SELECT parent, child FROM edges UNION ALL
            SELECT a.job_name, b.job_name FROM sup a JOIN sup b ON a.k = b.k + 3 WHERE a.k % 20 = 8),
  walk(origin, job) AS (SELECT parent, child FROM wrong UNION SELECT w.origin, e.child FROM walk w JOIN wrong e ON e.parent = w.job)
  SELECT DISTINCT origin AS job_name FROM walk WHERE origin = job""")
def q_registry_cycles(t):
    """G2 guard: jobs on a cycle, found by peeling, when some jobs wrongly come before a job they depend on."""
    s = fx.suppliers(t).select("k", "job_name")
    back = s.filter(F.col("k") % 20 == 8).select((F.col("k") - 3).alias("k"), F.col("job_name").alias("parent")).join(
        s.withColumnRenamed("job_name", "child"), "k").select("parent", "child")
    return G.cycles(_edges(t).unionByName(back))


@register("blast_radius", FPB + """SELECT s.job_name, count(c.job) AS impacted_jobs FROM slow s
  LEFT JOIN clo c ON c.anc = s.job_name GROUP BY s.job_name""")
def q_blast_radius(t):
    """Descendants of every slow job."""
    m = M.job_metrics(fx.runs(t))
    return G.impacted(_slow(m), G.closure(_edges(t)))


def _search(t, m):
    """Ancestors of the anomalous and the slow jobs."""
    return G.ancestors_of(_anomalous(m).select("job_name").unionByName(_slow(m)), _edges(t))


def gold_table(t):
    """Gold metrics computed once and written to the shared checkpoint folder (as the pipeline does)."""
    from runsight.operators.graph import _materialize
    m, _ = _materialize(M.job_metrics(fx.runs(t)), "gold-metrics", F.count(F.lit(1)).alias("n"))
    return m


def _fp(t, as_of, infra_minutes):
    m = gold_table(t)
    infra = S.infra_signals(fx.infra_metrics(t), as_of, infra_minutes)
    return FP.fingerprint(m, _edges(t), infra, fx.ci_runs(t), as_of)


MAXTS = "(SELECT max(ts) FROM ev)"
FAIL10 = "(SELECT max(ts) FROM ev WHERE event_type = 'purchase' AND pk >= 50) + INTERVAL 10 MINUTE"
FAIL3 = "(SELECT max(ts) FROM ev WHERE event_type = 'purchase' AND pk >= 50) + INTERVAL 3 MINUTE"


@register("fingerprint_quiet", O.fingerprint_sql(MAXTS, 30))
def q_fingerprint_quiet(t):
    """F1-F6 with the default 30-minute infra window at the newest event."""
    return _fp(t, fx.events_max_ts(t), 30)


@register("fingerprint_noisy", O.fingerprint_sql(MAXTS, 720))
def q_fingerprint_noisy(t):
    """F1-F6 with storage and compute errors in the last 12 h: infrastructure reachable."""
    return _fp(t, fx.events_max_ts(t), 720)


@register("fingerprint_ci", O.fingerprint_sql(FAIL10, 30))
def q_fingerprint_ci(t):
    """failed CI run 10 min before as_of adds 35."""
    return _fp(t, fx.ci_as_of(t, 10), 30)


@register("fingerprint_ci_infra", O.fingerprint_sql(FAIL3, 720))
def q_fingerprint_ci_infra(t):
    """failed CI run 3 min before as_of with compute errors adds 25."""
    return _fp(t, fx.ci_as_of(t, 3), 720)


# Every event is a CI run here; one of 97 fails.  as_of: 29 minutes after the last failure that is older than a day.
BUSY_FAIL = "(SELECT max(ts) FROM ev WHERE event_id % 97 = 5 AND ts < (SELECT max(ts) FROM ev) - INTERVAL 1 DAY)"
BUSY_SQL = O.fingerprint_sql(BUSY_FAIL + " + INTERVAL 29 MINUTE", 30).replace(
    "CASE WHEN pk >= 50 THEN 'failure' ELSE 'success' END", "CASE WHEN event_id % 97 = 5 THEN 'failure' ELSE 'success' END"
).replace("FROM ev WHERE event_type = 'purchase')", "FROM ev)")


@register("fingerprint_busy_ci", BUSY_SQL)
def q_fingerprint_busy_ci(t):
    """F5 on a busy CI: the failure counts however many newer runs there are."""
    ci, as_of = fx.busy_ci(t)
    return FP.fingerprint(gold_table(t), _edges(t), S.infra_signals(fx.infra_metrics(t), as_of, 30), ci, as_of)


@register("fingerprint_counts", O.fingerprint_sql(MAXTS, 30, """SELECT fingerprint_type, count(*) AS jobs,
  round_even(avg(evidence_score) * 1000000.0, 0) / 1000000.0 AS avg_score FROM fpx GROUP BY fingerprint_type"""))
def q_fingerprint_counts(t):
    """F6 summary: jobs and mean score per class."""
    from runsight.functions import rnd
    c = FP.fingerprint_counts(_fp(t, fx.events_max_ts(t), 30))
    return c.withColumn("avg_score", rnd("avg_score", 6))


@register("fingerprint_ranked", O.fingerprint_sql(MAXTS, 720, """SELECT job_name, fingerprint_type, evidence_score
  FROM fpx ORDER BY evidence_score DESC, job_name"""))
def q_fingerprint_ranked(t):
    """Fingerprints by evidence score."""
    fp = _fp(t, fx.events_max_ts(t), 720)
    return fp.select("job_name", "fingerprint_type", "evidence_score").orderBy(F.col("evidence_score").desc(),
                                                                             "job_name")


@register("infra_signals_30m", O.with_(O.EV, "now_t AS (SELECT max(ts) AS t FROM ev WHERE event_type = 'error')", O.infra_cte(30))
          + "SELECT se AS storage_errors, ce AS compute_errors FROM inf")
def q_infra_signals(t):
    """Error counters summed over the 30 minutes up to the newest error."""
    m = fx.infra_metrics(t)
    return S.infra_signals(m, m.select(F.max("ts")).scalar())


@register("infra_signals_720m", O.with_(O.EV, "now_t AS (SELECT max(ts) AS t FROM ev)", O.infra_cte(720))
          + "SELECT se AS storage_errors, ce AS compute_errors FROM inf")
def q_infra_signals_long(t):
    """Error counters summed over 720 minutes."""
    return S.infra_signals(fx.infra_metrics(t), fx.events_max_ts(t), 720)


@register("ci_recent_runs", O.with_(O.EV, O.ci_cte(FAIL10)) + """SELECT strftime(created_at, '%Y-%m-%d %H:%M:%S.%f')
  AS created_at, conclusion, name FROM ci10""")
def q_ci_recent(t):
    """Ten newest CI runs at or before as_of."""
    return S.ci_recent(fx.ci_runs(t), fx.ci_as_of(t, 10), 10)


@register("ci_nearest_failure", O.with_(O.EV, O.ci_cte(FAIL10)) + f"SELECT {O.R('ci_minutes', 6)} AS ci_minutes FROM cim")
def q_ci_nearest(t):
    """Minutes since the nearest failed CI run at or before as_of."""
    from runsight.functions import rnd
    from runsight.functions.core import lit_ts
    a = fx.ci_as_of(t, 10)
    return S.nearest_failure(fx.ci_runs(t).filter(F.col("created_at") <= lit_ts(a)), a).select(rnd("ci_minutes", 6).alias("ci_minutes"))


@register("ci_nearest_per_run", O.with_(O.SUP, O.RUNS) + f""", f AS (
  SELECT CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey * 37 % 86400) AS created_at,
         max('ci-' || CAST(o_orderkey AS VARCHAR)) AS name FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
b AS (SELECT r.job_name, r.run_id, r.start_time, f.created_at AS b_at, f.name AS b_name
      FROM runs r ASOF LEFT JOIN f ON r.start_time >= f.created_at),
n AS (SELECT b.*, f.created_at AS a_at, f.name AS a_name FROM b ASOF LEFT JOIN f ON b.start_time <= f.created_at),
p AS (SELECT *, CASE WHEN b_at IS NULL THEN true WHEN a_at IS NULL THEN false
                     ELSE a_at - start_time < start_time - b_at END AS later FROM n),
q AS (SELECT job_name, run_id, start_time, CASE WHEN later THEN a_name ELSE b_name END AS ci_name,
             CASE WHEN later THEN a_at ELSE b_at END AS ci_at FROM p)
SELECT job_name, run_id, ci_name, {O.TS('ci_at')} AS ci_at,
  {O.R('abs(epoch_us(ci_at) - epoch_us(start_time)) / 60000000.0::DOUBLE', 6)} AS ci_minutes FROM q""")
def q_ci_nearest_per_run(t):
    """J12 per run: the failed CI run nearest to each run's start, on either side."""
    from runsight.functions import rnd
    r = fx.runs(t).select("job_name", "run_id", "start_time")
    return (S.nearest_failure_per_run(r, fx.ci_history(t))
            .select("job_name", "run_id", "ci_name", "ci_at", rnd("ci_minutes", 6).alias("ci_minutes")))


def _views(t):
    """Gold tables written by the pipeline, registered as views (S11); signals are read at the newest event."""
    from runsight.plans import pipeline
    from runsight.plans.views import register_views
    from runsight.session import scratch_dir
    gold = pipeline.run(fx.runs(t), fx.registry(t), fx.infra_metrics(t), fx.ci_runs(t), fx.deadlines(t),
                        fx.DEADLINE_AS_OF, scratch_dir(t.spark, "gold-views"), signals_as_of=fx.events_max_ts(t))
    urgent = gold["gold_job_metrics"].filter(F.col("verdict").isin(*FP.URGENT))
    register_views(t.spark, {**gold, "silver_job_runs": fx.runs(t), "incidents": fx.incidents(t, urgent)})
    return t.spark


@register("view_heatmap", O.BASE + """SELECT job_name, team, verdict, priority_score, latest_duration, sla_minutes,
  total_runs FROM m""")
def q_view_heatmap(t):
    """The heatmap page as Spark SQL over the registered gold views."""
    from runsight.plans.views import page
    return page(_views(t), "heatmap")


@register("view_urgent", O.BASE + """SELECT job_name, team, verdict, latest_duration, sla_minutes FROM m
  WHERE verdict IN ('breached', 'at_risk')""")
def q_view_urgent(t):
    """The alert poller's urgent-jobs query as Spark SQL."""
    from runsight.plans.views import page
    return page(_views(t), "urgent")


@register("view_deadline_gate", O.with_(O.SUP, O.RUNS) + "SELECT count(DISTINCT job_name) AS n FROM runs")
def q_view_deadline_gate(t):
    """The deadline page's distinct-jobs gate (D23) as Spark SQL."""
    from runsight.plans.views import page, register_views
    register_views(t.spark, {"silver_job_runs": fx.runs(t)})
    return page(t.spark, "deadline_gate")


@register("view_fingerprints", O.fingerprint_sql(MAXTS, 30, """SELECT job_name,
  fingerprint_type, evidence_score, statistical_evidence, external_evidence, recommended_action, route_to_team
  FROM fpx"""))
def q_view_fingerprints(t):
    """The fingerprint page as Spark SQL over the gold view."""
    from runsight.plans.views import page
    return page(_views(t), "fingerprints")


