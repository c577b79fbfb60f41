"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the driver's tables (pre-registered views).  The
fixture mappings are restated here as CTEs so that the oracle does not share
code with the Spark side.  Rounding uses ``round_even(x * 10^n, 0) / 10^n``,
the exact twin of ``rint`` scaling on the Spark side.
"""

from __future__ import annotations


def R(expr: str, n: int) -> str:
    s = 10 ** n
    return f"(round_even(({expr}) * {s}.0, 0) / {s}.0 + 0.0::DOUBLE)"


def TS(expr: str) -> str:
    """Timestamp as sink text (same pattern as the Spark side)."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


SUP = """sup AS (
  SELECT s.s_suppkey AS k, s.s_name AS job_name, r.r_name AS team
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

RUNS = """runs AS (
  SELECT job_name, team,
         CASE k % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS impact,
         CAST(40 + k % 12 AS DOUBLE) AS sla_minutes, CAST(50000 AS BIGINT) AS normal_rows,
         printf('%010d-%02d-%010d', l_orderkey, l_linenumber, l_partkey) AS run_id,
         CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_orderkey % 86400) AS start_time,
         l_quantity AS duration_minutes, CAST(floor(l_extendedprice) AS BIGINT) AS rows_processed,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'failed' ELSE 'success' END AS status,
         l_linenumber AS line_no, k
  FROM lineitem JOIN sup ON l_suppkey = sup.k)"""


def metrics_cte(runs: str = "runs", name: str = "m", min_runs: int = 30) -> str:
    """Per-job metrics with verdict and priority (E semantics, rounded)."""
    lk = "(start_time, run_id)"
    td = f"CASE WHEN s_d > 0 THEN {R('(l_d - a_d) / s_d', 3)} ELSE 0.0 END"
    vd = f"CASE WHEN s_r > 0 THEN {R('(CAST(l_r AS DOUBLE) - a_r) / s_r', 3)} ELSE 0.0 END"
    w = f"total_runs >= {min_runs}"
    return f"""{name}_a AS (
  SELECT job_name, count(*) AS total_runs, count(duration_minutes) AS duration_runs,
         avg(duration_minutes) AS a_d, stddev_samp(duration_minutes) AS s_d,
         quantile_cont(duration_minutes, 0.95) AS p_d,
         avg(rows_processed) AS a_r, stddev_samp(rows_processed) AS s_r,
         avg(CASE WHEN status = 'failed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS f,
         arg_max(team, {lk}) AS team, arg_max(impact, {lk}) AS impact, arg_max(sla_minutes, {lk}) AS sla_minutes,
         arg_max(duration_minutes, {lk}) AS l_d, arg_max(rows_processed, {lk}) AS l_r,
         arg_max(status, {lk}) AS latest_status, max(start_time) AS latest_start_time
  FROM {runs} WHERE job_name IS NOT NULL GROUP BY job_name),
{name}_b AS (
  SELECT job_name, team, impact, sla_minutes, total_runs, duration_runs,
         {R('l_d', 2)} AS latest_duration, l_r AS latest_rows, latest_status, latest_start_time,
         CASE WHEN {w} THEN {R('a_d', 2)} END AS avg_duration,
         CASE WHEN {w} THEN {R('p_d', 2)} END AS p95_duration,
         CASE WHEN {w} THEN {R('s_d', 2)} END AS stddev_duration,
         CASE WHEN {w} THEN {R('a_r', 2)} END AS avg_rows,
         CASE WHEN {w} THEN {R('s_r', 2)} END AS stddev_rows,
         CASE WHEN {w} THEN {R('f', 6)} END AS failure_rate,
         CASE WHEN {w} THEN {td} END AS time_drift_score,
         CASE WHEN {w} THEN {vd} END AS volume_drift_score
  FROM {name}_a),
{name} AS (
  SELECT *,
         CASE WHEN time_drift_score IS NULL THEN 'insufficient_data'
              WHEN latest_duration > sla_minutes THEN 'breached'
              WHEN coalesce(time_drift_score, 0.0) > 1.5 OR coalesce(volume_drift_score, 0.0) < -1.5 THEN 'at_risk'
              ELSE 'safe' END AS verdict,
         {R("abs(time_drift_score) * CASE impact WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END", 2)}
           AS priority_score
  FROM {name}_b)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


METRICS_COLS = ("job_name, team, impact, sla_minutes, total_runs, duration_runs, latest_duration, latest_rows, "
                "latest_status, " + TS("latest_start_time") + " AS latest_start_time, avg_duration, p95_duration, "
                "stddev_duration, avg_rows, stddev_rows, failure_rate, time_drift_score, volume_drift_score, "
                "verdict, priority_score")

BASE = with_(SUP, RUNS, metrics_cte())


def with_rec(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


EDGES = """edges AS (
  SELECT p.job_name AS parent, c.job_name AS child FROM sup c JOIN sup p ON p.k = c.k - 1 WHERE c.k % 20 <> 0
  UNION ALL
  SELECT p.job_name, c.job_name FROM sup c JOIN sup p ON p.k = c.k - 2 WHERE c.k % 20 IN (5, 11))"""

CLOSURE = """cr(anc, job, hops) AS (
  SELECT parent, child, 1 FROM edges
  UNION ALL SELECT cr.anc, e.child, cr.hops + 1 FROM cr JOIN edges e ON cr.job = e.parent),
clo AS (SELECT anc, job, min(hops) AS hops FROM cr GROUP BY anc, job)"""

EV = """ev AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS pk FROM events)"""

SLOW = """slow AS (SELECT job_name FROM m WHERE coalesce(time_drift_score, 0.0) > 1.5),
an AS (SELECT * FROM m WHERE verdict IN ('breached', 'at_risk')),
cnt AS (SELECT job, count(*) AS n_anc FROM clo GROUP BY job),
relp AS (
  SELECT a.job_name, s.job_name AS s FROM an a JOIN slow s ON s.job_name = a.job_name
  UNION SELECT a.job_name, c.anc FROM an a JOIN clo c ON c.job = a.job_name JOIN slow s ON s.job_name = c.anc
  UNION SELECT a.job_name, c.job FROM an a JOIN clo c ON c.anc = a.job_name JOIN slow s ON s.job_name = c.job),
unrel AS (SELECT a.job_name, (SELECT count(*) FROM slow) - (SELECT count(*) FROM relp WHERE relp.job_name = a.job_name)
            AS unrelated_slow FROM an a),
roots AS (SELECT c.job AS job_name, arg_max(c.anc, (coalesce(cnt.n_anc, 0), c.anc)) AS root, count(*) AS slow_ancestors
          FROM clo c JOIN slow s ON s.job_name = c.anc LEFT JOIN cnt ON cnt.job = c.anc
          WHERE c.job IN (SELECT job_name FROM an) GROUP BY c.job),
pth(root, job, path, hops) AS (
  SELECT DISTINCT root, root, root, 0 FROM roots
  UNION ALL SELECT p.root, e.child, p.path || ' → ' || e.child, p.hops + 1 FROM pth p JOIN edges e ON e.parent = p.job),
chains AS (SELECT r.job_name, r.root, arg_min(p.path, (p.hops, p.path)) AS chain
           FROM roots r JOIN pth p ON p.root = r.root AND p.job = r.job_name GROUP BY r.job_name, r.root)"""


def ci_cte(as_of_sql: str) -> str:
    """CI runs, the ten newest at or before as_of, minutes since the last failure among all of them."""
    return f"""ci AS (SELECT ts AS created_at, CASE WHEN pk >= 50 THEN 'failure' ELSE 'success' END AS conclusion,
               'ci-' || CAST(event_id AS VARCHAR) AS name FROM ev WHERE event_type = 'purchase'),
now_t AS (SELECT {as_of_sql} AS t),
ci10 AS (SELECT ci.* FROM ci, now_t WHERE created_at <= now_t.t ORDER BY created_at DESC, name DESC LIMIT 10),
cim AS (SELECT min(abs(epoch_us((SELECT t FROM now_t)) - epoch_us(created_at)) / 60000000.0::DOUBLE) AS ci_minutes
        FROM ci, now_t WHERE created_at <= now_t.t AND conclusion = 'failure')"""


def infra_cte(minutes: int) -> str:
    return f"""inf AS (SELECT CAST(coalesce(sum(CASE WHEN pk % 2 = 0 THEN 1.0 END), 0) AS BIGINT) AS se,
                      CAST(coalesce(sum(CASE WHEN pk % 2 = 0 THEN NULL ELSE 1.0 END), 0) AS BIGINT) AS ce
  FROM ev, now_t WHERE event_type = 'error' AND ev.ts > now_t.t - INTERVAL {minutes} MINUTE AND ev.ts <= now_t.t)"""


def fingerprint_select() -> str:
    td, vd = "coalesce(a.time_drift_score, 0.0)", "coalesce(a.volume_drift_score, 0.0)"
    se, ce, cm = "(SELECT se FROM inf)", "(SELECT ce FROM inf)", "(SELECT ci_minutes FROM cim)"
    gap = "abs(a.latest_duration / nullif(a.avg_duration, 0) - a.latest_rows / nullif(a.avg_rows, 0))"
    hit = f"({cm} IS NOT NULL AND {cm} < 30)"
    return f"""fp0 AS (
  SELECT a.*, u.unrelated_slow, r.root, ch.chain, rt.team AS root_team,
    CASE WHEN {vd} < -1.5 AND abs({td}) < 0.5 THEN 'data_quality_issue'
         WHEN coalesce(u.unrelated_slow, 0) >= 2 AND ({se} > 0 OR {ce} > 0) THEN 'infrastructure_issue'
         WHEN r.root IS NOT NULL THEN 'cascade_failure'
         WHEN {vd} > 1.5 AND {td} > 1.5 AND coalesce(a.avg_duration <> 0, false) AND coalesce({gap} < 0.3, false)
           THEN 'volume_spike'
         ELSE 'logic_bug' END AS ft
  FROM an a LEFT JOIN unrel u ON u.job_name = a.job_name LEFT JOIN roots r ON r.job_name = a.job_name
  LEFT JOIN chains ch ON ch.job_name = a.job_name LEFT JOIN m rt ON rt.job_name = r.root)
SELECT job_name, team, verdict, ft AS fingerprint_type,
  least(CASE ft WHEN 'data_quality_issue' THEN 70 WHEN 'infrastructure_issue' THEN 85 WHEN 'cascade_failure' THEN 75
       WHEN 'volume_spike' THEN 65
       ELSE 40 + CASE WHEN {hit} THEN (CASE WHEN {ce} > 0 AND {cm} < 5 THEN 25 ELSE 35 END) ELSE 0 END END, 100)
    AS evidence_score,
  CASE ft WHEN 'data_quality_issue' THEN 'Volume drift ' || CAST({R(vd.replace('a.', ''), 2)} AS VARCHAR) || 'σ — time drift normal'
    WHEN 'infrastructure_issue' THEN CAST(unrelated_slow AS VARCHAR) || ' unrelated jobs slow simultaneously'
    WHEN 'cascade_failure' THEN 'Root: ' || root || ' | Chain: ' || coalesce(chain, root || ' → ' || job_name)
    WHEN 'volume_spike' THEN 'Duration and rows up proportionally — expected linear scaling'
    ELSE 'Isolated: time drift ' || CAST({R(td.replace('a.', ''), 2)} AS VARCHAR) || 'σ — dependencies healthy' END
    AS statistical_evidence,
  CASE WHEN ft = 'infrastructure_issue'
         THEN 'Storage errors: ' || CAST({se} AS VARCHAR) || ' | Compute errors: ' || CAST({ce} AS VARCHAR)
       WHEN ft = 'logic_bug' AND {hit} THEN 'Failed CI run ' || CAST({R(cm, 1)} AS VARCHAR) || 'min ago'
       ELSE 'none' END AS external_evidence,
  CASE WHEN ft IN ('data_quality_issue', 'volume_spike') THEN 'ingestion_team'
       WHEN ft = 'infrastructure_issue' THEN 'devops_team'
       WHEN ft = 'cascade_failure' THEN coalesce(root_team, team) ELSE team END AS route_to_team,
  CASE ft WHEN 'data_quality_issue' THEN 'Check upstream data source, not a pipeline bug'
    WHEN 'infrastructure_issue' THEN 'Route to DevOps — do NOT page pipeline engineers'
    WHEN 'cascade_failure' THEN 'Fix ' || root || ' first — this job recovers automatically'
    WHEN 'volume_spike' THEN 'Monitor — will self-resolve as volume normalises'
    ELSE 'Check recent deployments and job logs' END AS recommended_action,
  CAST(coalesce(unrelated_slow, 0) AS BIGINT) AS unrelated_slow, root AS cascade_root,
  strftime((SELECT t FROM now_t), '%Y-%m-%d %H:%M:%S.%f') AS detected_at
FROM fp0"""


def fingerprint_sql(as_of_sql: str, infra_minutes: int, tail: str = "") -> str:
    body = with_rec(SUP, RUNS, metrics_cte(), EDGES, CLOSURE, SLOW, EV, ci_cte(as_of_sql), infra_cte(infra_minutes),
                    fingerprint_select().split("\nSELECT ", 1)[0])
    sel = "SELECT " + fingerprint_select().split("\nSELECT ", 1)[1]
    if tail:
        return body + ", fpx AS (" + sel + ")\n" + tail
    return body + sel


GRAPH = with_rec(SUP, RUNS, metrics_cte(), EDGES, CLOSURE)


RUNS_TIGHT = """runs_t AS (SELECT * REPLACE (CAST(26 + 2 * (k % 12) AS DOUBLE) AS sla_minutes) FROM runs)"""

TX = """tx AS (SELECT user_id AS account_id, event_id // 2 AS txn_id, value AS amount, CAST(ts AS TIMESTAMP) AS ts FROM events)"""

INC_AS_OF = "TIMESTAMP '2001-11-05 00:00:00'"

INCIDENTS = f"""inc AS (
  SELECT m.job_name, m.team, m.verdict, {INC_AS_OF} - to_minutes(s.k + 1) AS detected_at,
         CASE WHEN s.k % 8 = 0 THEN {INC_AS_OF} - to_minutes(s.k + 1) + to_minutes(s.k % 50) END AS resolved_at
  FROM m JOIN sup s ON s.job_name = m.job_name WHERE m.verdict IN ('breached', 'at_risk') AND s.k % 4 = 0)"""

TASKS = """ti AS (SELECT job_name AS dag_id, run_id, start_time AS start_date,
               CASE WHEN line_no = 7 THEN NULL ELSE duration_minutes * 60.0 END AS duration, status AS state FROM runs),
reg AS (SELECT job_name, team, CASE k % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS impact,
               CAST(40 + k % 12 AS DOUBLE) AS sla_minutes, CAST(50000 AS BIGINT) AS normal_rows, k FROM sup),
known AS (SELECT * FROM reg WHERE k % 10 <> 9)"""

RESULTS = """res AS (
  SELECT s.job_name, CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS recorded_at,
         max(CAST(floor(o_totalprice) AS BIGINT)) AS rows_processed
  FROM orders JOIN sup s ON s.k = o_custkey % (SELECT count(*) FROM supplier) GROUP BY 1, 2)"""
