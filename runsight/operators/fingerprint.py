"""Cause classification of anomalous jobs.

Rules in priority order: data quality, infrastructure, cascade, volume spike,
logic bug.  The graph facts (unrelated slow count, cascade root, chain) come
from a search upwards from the jobs concerned; the infra and CI signals are one-row aggregates attached
as scalar subqueries.  The rule chain itself is a single ``when`` expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.functions.core import lit_ts, rnd
from runsight.operators import graph as G
from runsight.sources.signals import COMPUTE, STORAGE, ci_window, nearest_failure

URGENT = ("breached", "at_risk")

# Fixed values of the classifier (scores, routes, thresholds and texts).
SCORES = {"data_quality_issue": 70, "infrastructure_issue": 85, "cascade_failure": 75,
          "volume_spike": 65, "logic_bug": 40}
CI_BONUS, CI_BONUS_WITH_COMPUTE = 35, 25
CI_WINDOW_MIN, CI_COMPUTE_WINDOW_MIN = 30, 5
SLOW_Z = 1.5
TEXT = {
    "dq_stat": "Volume drift {v}σ — time drift normal",
    "dq_action": "Check upstream data source, not a pipeline bug",
    "infra_stat": "{n} unrelated jobs slow simultaneously",
    "infra_ext": "Storage errors: {s} | Compute errors: {c}",
    "infra_action": "Route to DevOps — do NOT page pipeline engineers",
    "cascade_stat": "Root: {root} | Chain: {chain}",
    "cascade_action": "Fix {root} first — this job recovers automatically",
    "spike_stat": "Duration and rows up proportionally — expected linear scaling",
    "spike_action": "Monitor — will self-resolve as volume normalises",
    "bug_stat": "Isolated: time drift {t}σ — dependencies healthy",
    "bug_ext": "Failed CI run {m}min ago",
    "bug_action": "Check recent deployments and job logs",
}


def _s(x):
    return F.col(x).cast("string") if isinstance(x, str) else x.cast("string")


def fingerprint(metrics: DataFrame, edges_df: DataFrame, infra: DataFrame, ci: DataFrame, as_of,
                root: str = "nearest") -> DataFrame:
    """One row per anomalous job (verdict breached or at_risk).

    The graph is searched upwards from the anomalous and the slow jobs only: that gives the slow ancestors of the
    anomalous, the anomalous ancestors of the slow (so their slow descendants) and the ancestor counts of the slow.

    metrics: gold job metrics; edges_df: parent/child edges; infra: one-row
    signals (storage_errors, compute_errors); ci: created_at, conclusion, name.
    """
    anomalous = metrics.filter(F.col("verdict").isin(*URGENT))
    slow = metrics.filter(F.coalesce("time_drift_score", F.lit(0.0)) > SLOW_Z).select("job_name")
    reach = G.ancestors_of(anomalous.select("job_name").unionByName(slow), edges_df)
    unrel = G.unrelated_slow(anomalous, slow, reach)
    roots = G.cascade_root(anomalous, slow, reach, G.ancestor_counts(reach), mode=root)
    chains = G.shortest_paths(roots.select("root", "job_name"), reach, edges_df)
    root_team = metrics.select(F.col("job_name").alias("root"), F.col("team").alias("root_team"))

    sig = infra.select(F.struct(F.col(STORAGE).alias("s"), F.col(COMPUTE).alias("c"))).scalar()  # one subquery
    s_err, c_err = sig.s, sig.c
    ci_min = nearest_failure(ci_window(ci, as_of, CI_WINDOW_MIN), as_of).select("ci_minutes").scalar()

    a = (anomalous.join(unrel, "job_name", "left")
         .join(roots, "job_name", "left")
         .join(chains.select("root", "job_name", "chain"), ["root", "job_name"], "left")
         .join(root_team, "root", "left"))
    td = F.coalesce("time_drift_score", F.lit(0.0))
    vd = F.coalesce("volume_drift_score", F.lit(0.0))
    ratio_gap = F.abs(F.try_divide(F.col("latest_duration"), F.col("avg_duration"))
                      - F.try_divide(F.col("latest_rows").cast("double"), F.col("avg_rows")))
    is_dq = (vd < -1.5) & (F.abs(td) < 0.5)
    is_infra = (F.coalesce("unrelated_slow", F.lit(0)) >= 2) & ((s_err > 0) | (c_err > 0))
    is_cascade = F.col("root").isNotNull()
    is_spike = ((vd > 1.5) & (td > 1.5) & F.coalesce(F.col("avg_duration") != 0, F.lit(False))
                & F.coalesce(ratio_gap < 0.3, F.lit(False)))
    ci_hit = ci_min.isNotNull() & (ci_min < CI_WINDOW_MIN)
    bug_bonus = (F.when(ci_hit, F.when((c_err > 0) & (ci_min < CI_COMPUTE_WINDOW_MIN), CI_BONUS_WITH_COMPUTE)
                        .otherwise(CI_BONUS)).otherwise(0))

    def txt(key, **kw):
        parts, s = [], TEXT[key]
        while "{" in s:
            pre, rest = s.split("{", 1)
            name, s = rest.split("}", 1)
            parts += [F.lit(pre), _s(kw[name])]
        parts.append(F.lit(s))
        return F.concat(*parts)

    ftype = (F.when(is_dq, "data_quality_issue").when(is_infra, "infrastructure_issue")
             .when(is_cascade, "cascade_failure").when(is_spike, "volume_spike").otherwise("logic_bug"))
    out = a.select("*", ftype.alias("fingerprint_type"))
    t = F.col("fingerprint_type")
    chain = F.coalesce(F.col("chain"), F.concat_ws(G.ARROW, "root", "job_name"))
    score = (F.when(t == "logic_bug", F.lit(SCORES["logic_bug"]) + bug_bonus)
             .otherwise(F.create_map(*[x for k, v in SCORES.items() for x in (F.lit(k), F.lit(v))])[t]))
    stat = (F.when(t == "data_quality_issue", txt("dq_stat", v=rnd(vd, 2)))
            .when(t == "infrastructure_issue", txt("infra_stat", n=F.col("unrelated_slow")))
            .when(t == "cascade_failure", txt("cascade_stat", root=F.col("root"), chain=chain))
            .when(t == "volume_spike", F.lit(TEXT["spike_stat"]))
            .otherwise(txt("bug_stat", t=rnd(td, 2))))
    ext = (F.when(t == "infrastructure_issue", txt("infra_ext", s=s_err, c=c_err))
           .when((t == "logic_bug") & ci_hit, txt("bug_ext", m=rnd(ci_min, 1)))
           .otherwise(F.lit("none")))
    action = (F.when(t == "data_quality_issue", F.lit(TEXT["dq_action"]))
              .when(t == "infrastructure_issue", F.lit(TEXT["infra_action"]))
              .when(t == "cascade_failure", txt("cascade_action", root=F.col("root")))
              .when(t == "volume_spike", F.lit(TEXT["spike_action"]))
              .otherwise(F.lit(TEXT["bug_action"])))
    route = (F.when(t.isin("data_quality_issue", "volume_spike"), F.lit("ingestion_team"))
             .when(t == "infrastructure_issue", F.lit("devops_team"))
             .when(t == "cascade_failure", F.coalesce("root_team", "team"))
             .otherwise(F.col("team")))
    return out.select(
        "job_name", "team", "verdict", "fingerprint_type",
        F.least(score, F.lit(100)).alias("evidence_score"),
        stat.alias("statistical_evidence"), ext.alias("external_evidence"),
        route.alias("route_to_team"), action.alias("recommended_action"),
        F.coalesce("unrelated_slow", F.lit(0)).cast("long").alias("unrelated_slow"),
        F.col("root").alias("cascade_root"),
        lit_ts(as_of).alias("detected_at"))


def fingerprint_counts(fp: DataFrame) -> DataFrame:
    return fp.groupBy("fingerprint_type").agg(F.count(F.lit(1)).alias("jobs"),
                                              F.avg("evidence_score").alias("avg_score"))
