"""SLA, deadline, incident, quality, reconciliation, velocity, summary and extract queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from runsight.functions import rnd
from runsight.operators import deadlines as D
from runsight.operators import fingerprint as FP
from runsight.operators import graph as G
from runsight.operators import incidents as K
from runsight.operators import metrics as M
from runsight.operators import quality as Q
from runsight.operators import recon as RC
from runsight.operators import sla as H
from runsight.operators import summaries as SM
from runsight.operators import velocity as VL
from runsight.plans import oracle as O
from runsight.plans.catalog import register
from runsight.session import scratch_dir
from runsight.sources import extract as X
from runsight.sources import fixtures as fx
from runsight.sources import signals as S

R = O.R
TIGHT = O.with_(O.SUP, O.RUNS, O.RUNS_TIGHT, O.metrics_cte(runs="runs_t"))
VG = """vg AS (SELECT job_name, avg(CASE WHEN pos <= sp THEN rows_processed END) AS first_rows,
                avg(CASE WHEN pos > n - sp THEN rows_processed END) AS last_rows
  FROM (SELECT job_name, rows_processed,
          row_number() OVER (PARTITION BY job_name ORDER BY start_time, run_id) AS pos,
          count(*) OVER (PARTITION BY job_name) AS n,
          greatest(1, count(*) OVER (PARTITION BY job_name) // 5) AS sp
        FROM runs_t WHERE job_name IN (SELECT job_name FROM m WHERE avg_duration IS NOT NULL))
  GROUP BY job_name),
vg2 AS (SELECT *, CASE WHEN last_rows > first_rows * 1.1 THEN 'growing' WHEN last_rows < first_rows * 0.9
                       THEN 'shrinking' ELSE 'stable' END AS volume_growth FROM vg)"""
HEALTH = f"""h AS (SELECT m.job_name, team, impact, {R('avg_duration / sla_minutes', 3)} AS tightness_score,
  volume_growth, avg_duration, sla_minutes,
  CASE WHEN {R('avg_duration / sla_minutes', 3)} > 0.8 THEN round_even(sla_minutes * 1.3, 0) ELSE sla_minutes END
    AS recommended_sla
  FROM m LEFT JOIN vg2 ON vg2.job_name = m.job_name WHERE avg_duration IS NOT NULL)"""


def _tight_metrics(t):
    r = fx.runs_tight(t)
    return r, M.job_metrics(r)


VG_UNDATED = """runs_n AS (SELECT * REPLACE (CASE WHEN line_no <> 7 THEN start_time END AS start_time) FROM runs_t),
""" + VG.replace("FROM runs_t WHERE", "FROM runs_n WHERE").replace("ORDER BY start_time,", "ORDER BY start_time NULLS FIRST,")


GROWTH = f"""
  SELECT job_name, {R('first_rows', 6)} AS first_rows, {R('last_rows', 6)} AS last_rows, volume_growth FROM vg2"""


def _growth(r, m):
    return H.volume_growth(r.join(m.filter(F.col("avg_duration").isNotNull()).select("job_name"), "job_name", "left_semi"))


@register("volume_growth", TIGHT + ", " + VG + GROWTH)
def q_volume_growth(t):
    """First vs last 20 % of each job's runs."""
    return _growth(*_tight_metrics(t))


@register("volume_growth_undated", TIGHT + ", " + VG_UNDATED + GROWTH)
def q_volume_growth_undated(t):
    """W2/H2 when some runs have no start time: they come first."""
    r, m = _tight_metrics(t)
    return _growth(fx.undated_runs(r), m)


@register("sla_health", TIGHT + ", " + VG + ", " + HEALTH + " SELECT * FROM h")
def q_sla_health(t):
    """H1-H3/T5: tightness, growth and recommended SLA per warmed job."""
    r, m = _tight_metrics(t)
    return H.sla_health(r, m)


@register("sla_bands", TIGHT + ", " + VG + ", " + HEALTH + """ SELECT job_name, tightness_score,
  CASE WHEN tightness_score > 0.8 THEN 'red' WHEN tightness_score > 0.6 THEN 'orange' ELSE 'green' END AS band,
  CAST(trunc(tightness_score * 100) AS INTEGER) AS pct_of_sla,
  CASE WHEN tightness_score > 0.8 THEN recommended_sla END AS recommend_sla FROM h""")
def q_sla_bands(t):
    """H4: tightness band and percent of SLA."""
    r, m = _tight_metrics(t)
    return H.tightness_band(H.sla_health(r, m))


def _deadline_sql(kolkata: bool) -> str:
    off = 330 if kolkata else 0
    tz = "Asia/Kolkata" if kolkata else "UTC"
    mk = "make_timestamp(year(lt), month(lt), day(lt), hour, minute, 0)"
    return O.with_(O.SUP, O.RUNS, O.metrics_cte(), f"""dl AS (
  SELECT ['ledger_lock', 'branch_close', 'fee_posting', 'night_seal'][k % 20 + 1] AS deadline_name,
         [6, 17, 22, 23][k % 20 + 1] AS hour, [30, 45, 55, 40][k % 20 + 1] AS minute,
         job_name, k // 20 AS pos FROM sup WHERE k % 20 < 4
  UNION ALL SELECT 'spare_window', 12, 15, NULL, NULL)""",
                   "now_t AS (SELECT TIMESTAMP '2001-11-04 22:45:00' AS t)",
                   f"""hdr AS (SELECT DISTINCT deadline_name, hour, minute, t, t + to_minutes({off}) AS lt FROM dl, now_t)""",
                   f"""d2 AS (SELECT deadline_name, t, (CASE WHEN {mk} < lt THEN {mk} + INTERVAL 1 DAY ELSE {mk} END)
                        - to_minutes({off}) AS deadline_time FROM hdr)""",
                   """crit AS (SELECT dl.deadline_name, string_agg(dl.job_name, ',' ORDER BY dl.pos) AS cj FROM dl
                        JOIN m ON m.job_name = dl.job_name WHERE m.verdict IN ('at_risk', 'breached')
                        GROUP BY dl.deadline_name)""",
                   """d3 AS (SELECT d2.*, (epoch_us(deadline_time) - epoch_us(t)) / 60000000.0::DOUBLE AS buf,
                        coalesce(cj, '') AS critical_jobs FROM d2 LEFT JOIN crit USING (deadline_name))""") + f"""
SELECT deadline_name, '{tz}' AS tz, strftime(deadline_time, '%Y-%m-%d %H:%M:%S.%f') AS deadline_time,
  {R('buf', 1)} AS buffer_minutes, critical_jobs,
  CASE WHEN buf < 30 OR critical_jobs <> '' THEN 'high' WHEN buf < 90 THEN 'medium' ELSE 'low' END AS risk_level,
  strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS checked_at FROM d3"""


@register("deadline_risk", _deadline_sql(False))
def q_deadline_risk(t):
    """Next deadline, buffer, critical jobs, risk (UTC deadlines)."""
    return D.deadline_risk(M.job_metrics(fx.runs(t)), fx.deadlines(t), fx.DEADLINE_AS_OF)


@register("deadline_risk_tz", _deadline_sql(True))
def q_deadline_risk_tz(t):
    """R1 with deadlines local to Asia/Kolkata."""
    return D.deadline_risk(M.job_metrics(fx.runs(t)), fx.deadlines(t, kolkata=True), fx.DEADLINE_AS_OF)


# ---- incidents -------------------------------------------------------------
INC = O.with_(O.SUP, O.RUNS, O.metrics_cte(), O.INCIDENTS)
TSF = "'%Y-%m-%d %H:%M:%S.%f'"


def _urgent_fp(t):
    from runsight.plans.q_graph import gold_table
    m = gold_table(t)
    fp = FP.fingerprint(m, G.edges(fx.registry(t)), S.infra_signals(fx.infra_metrics(t), fx.events_max_ts(t), 30),
                        fx.ci_runs(t), fx.events_max_ts(t))
    return m, m.filter(F.col("verdict").isin("breached", "at_risk")), fp


FP_PART = O.fingerprint_sql("(SELECT max(ts) FROM ev)", 30, tail="__TAIL__")
INC_FP = FP_PART.replace("__TAIL__", "").rstrip() + ", " + O.INCIDENTS + ", " + """det AS (
  SELECT a.job_name, a.team, a.verdict, coalesce(f.fingerprint_type, 'unknown') AS fingerprint_type,
    coalesce(CAST(f.evidence_score AS VARCHAR), '?') AS evidence_score,
    coalesce(f.statistical_evidence, 'No fingerprint available') AS statistical_evidence,
    coalesce(f.external_evidence, 'none') AS external_evidence,
    coalesce(f.recommended_action, 'Investigate manually') AS recommended_action,
    coalesce(f.route_to_team, a.team) AS route_to_team
  FROM an a LEFT JOIN fpx f ON f.job_name = a.job_name)
"""


def _report_sql(prefix: str) -> str:
    pad = lambda s: s.ljust(15)
    parts = ["'INCIDENT REPORT'", "'" + "=" * 24 + "'",
             f"'{pad('Job:')}' || job_name", f"'{pad('Team:')}' || team", f"'{pad('Verdict:')}' || verdict",
             f"'{pad('Fingerprint:')}' || fingerprint_type || ' (evidence score: ' || evidence_score || ')'",
             f"'{pad('Root cause:')}' || statistical_evidence", f"'{pad('Evidence:')}' || external_evidence",
             f"'{pad('Action:')}' || recommended_action", f"'{pad('Route to:')}' || route_to_team",
             f"'{pad('Detected at:')}' || strftime({prefix}detected_at, '%Y-%m-%d %H:%M:%S')",
             "'" + "=" * 24 + "'"]
    return "concat_ws(chr(10), " + ", ".join(parts) + ")"


@register("incident_report", INC_FP + f"""SELECT * REPLACE (strftime(detected_at, {TSF}) AS detected_at),
  {_report_sql('')} AS report FROM (SELECT *, {O.INC_AS_OF} AS detected_at FROM det)""")
def q_incident_report(t):
    """Urgent jobs with fingerprint details (defaults where none) and the report text."""
    m, urgent, fp = _urgent_fp(t)
    d = K.incident_details(urgent, fp)
    return K.incident_text(d.withColumn("detected_at", F.to_timestamp(F.lit(fx.INCIDENT_AS_OF))))


@register("incident_new_only", INC_FP + f"""SELECT job_name, team, verdict, fingerprint_type, evidence_score,
  route_to_team, strftime({O.INC_AS_OF}, {TSF}) AS detected_at FROM det
  WHERE job_name NOT IN (SELECT job_name FROM inc WHERE resolved_at IS NULL)""")
def q_incident_new_only(t):
    """Incidents only for urgent jobs without an open incident."""
    m, urgent, fp = _urgent_fp(t)
    inc = fx.incidents(t, urgent)
    new = K.open_incidents(urgent, fp, inc, fx.INCIDENT_AS_OF)
    return new.select("job_name", "team", "verdict", "fingerprint_type", "evidence_score", "route_to_team",
                      "detected_at")


@register("incident_resolved", INC + f"""SELECT job_name, strftime(detected_at, {TSF}) AS detected_at,
  strftime(resolved_at, {TSF}) AS resolved_at FROM inc""")
def q_incident_resolved(t):
    """K3: resolutions applied to the open incident table; of two the first counts."""
    urgent = M.job_metrics(fx.runs(t)).filter(F.col("verdict").isin("breached", "at_risk"))
    inc = fx.incidents(t, urgent)
    base = inc.withColumn("resolved_at", F.lit(None).cast("timestamp"))
    first = inc.filter(F.col("resolved_at").isNotNull())
    again = first.withColumn("resolved_at", F.col("resolved_at") + F.expr("INTERVAL 4 MINUTES"))
    return K.resolve(base, again.unionByName(first)).select("job_name", "detected_at",
                                                                                "resolved_at")


@register("incident_log", INC + f"""SELECT job_name, strftime(detected_at, {TSF}) AS detected_at,
  strftime(resolved_at, {TSF}) AS resolved_at, CASE WHEN resolved_at IS NOT NULL THEN 'resolved' ELSE 'open' END
  AS state FROM inc ORDER BY detected_at DESC, job_name LIMIT 20""")
def q_incident_log(t):
    """The 20 newest incidents with their state."""
    urgent = M.job_metrics(fx.runs(t)).filter(F.col("verdict").isin("breached", "at_risk"))
    return K.incident_log(fx.incidents(t, urgent), 20)


@register("mttr", INC + f"""SELECT team, count(*) AS resolved,
  {R('avg((epoch_us(resolved_at) - epoch_us(detected_at)) / 60000000.0::DOUBLE)', 6)} AS mttr_minutes
  FROM inc WHERE resolved_at IS NOT NULL GROUP BY team""")
def q_mttr(t):
    """K5/A10: mean time to resolution per team."""
    urgent = M.job_metrics(fx.runs(t)).filter(F.col("verdict").isin("breached", "at_risk"))
    return K.mttr(fx.incidents(t, urgent), ["team"])


# ---- quality ---------------------------------------------------------------
RUNS_ONLY = O.with_(O.SUP, O.RUNS)
DIRTY = O.with_(O.SUP, O.RUNS, """dirty AS (SELECT * REPLACE (CASE WHEN line_no = 7 THEN NULL
  ELSE duration_minutes END AS duration_minutes) FROM runs)""")
REQ = sorted(Q.REQUIRED)


def _dq_sql(src: str, cols: list[str], missing: list[str], by: str | None = None) -> str:
    present = [c for c in REQ if c in cols]
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in present)
    key = f"{by} AS run_date, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    msgs = []
    if missing:
        msgs.append("'Schema drift — missing columns: " + ", ".join(missing) + "'")
    for c in present:
        p = R(f"n_{c}::DOUBLE / row_count * 100.0", 1)
        msgs.append(f"CASE WHEN {p} > 5.0 THEN 'High null rate in {c}: ' || printf('%.1f', {p}) || '%' END")
    msgs.append("CASE WHEN row_count < 10 THEN 'Low volume: only ' || CAST(row_count AS VARCHAR) || "
                "' rows (expected 30+ for healthy system)' END")
    arr = "list_filter([" + ", ".join(msgs) + "], lambda x: x IS NOT NULL)"
    sel_key = "strftime(run_date, '%Y-%m-%d') AS run_date, " if by else ""
    return f"""{src}, g AS (SELECT {key}count(*) AS row_count, {nulls} FROM src{grp}),
  g2 AS (SELECT *, CASE WHEN row_count = 0 THEN [] ELSE {arr} END AS iss FROM g)
SELECT {sel_key}CASE WHEN row_count = 0 THEN 'WARM_UP' WHEN len(iss) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  row_count, CASE WHEN row_count = 0 THEN 0 ELSE greatest(0, 3 - len(iss)) END AS checks_passed,
  CASE WHEN row_count = 0 THEN 0 ELSE len(iss) END AS checks_failed, array_to_string(iss, ' | ') AS issues FROM g2"""


def _dq(df, by=None):
    rep = Q.quality_report(df, by=by)
    return rep.withColumn("issues", F.array_join("issues", " | "))


RUN_COLS = ["job_name", "team", "impact", "sla_minutes", "normal_rows", "run_id", "start_time", "duration_minutes",
            "rows_processed", "status", "line_no"]


@register("dq_report", _dq_sql(DIRTY + ", src AS (SELECT * FROM dirty)", RUN_COLS, []))
def q_dq_report(t):
    """Q1/Q3: quality report over runs with missing durations (FAIL on null rate)."""
    return _dq(fx.dirty_runs(t))


@register("dq_report_clean", _dq_sql(RUNS_ONLY + ", src AS (SELECT * FROM runs)", RUN_COLS, []))
def q_dq_report_clean(t):
    """Q1: clean runs PASS."""
    return _dq(fx.runs(t))


@register("dq_report_drift", _dq_sql(RUNS_ONLY + ", src AS (SELECT * EXCLUDE (team) FROM runs)",
                                     [c for c in RUN_COLS if c != "team"], ["team"]))
def q_dq_report_drift(t):
    """Q2: a dropped required column is reported as schema drift."""
    return _dq(fx.runs(t).drop("team"))


TYPED = ["job_name", "team", "impact", "sla_minutes", "normal_rows", "run_id", "start_time", "duration_minutes",
         "rows_processed", "status"]


def _types_sql() -> str:
    """Line 5 spells rows_processed as text, line 6 breaks off, line 7 lacks its duration and has a field more."""
    kinds = {**{c: f"'{Q.RUN_TYPES[c]}'" for c in TYPED}, "duration_minutes": "CASE WHEN l = 7 THEN NULL ELSE 'number' END",
             "rows_processed": "CASE WHEN l = 5 THEN 'string' ELSE 'integer' END"}
    rows = [f"SELECT '{c}' AS field, '{Q.RUN_TYPES[c]}' AS expected_type, {k} AS found_type, l FROM raw WHERE l <> 6"
            for c, k in kinds.items()]
    rows += ["SELECT 'retries', NULL, 'integer', l FROM raw WHERE l = 7", "SELECT NULL, NULL, 'unreadable', l FROM raw WHERE l = 6"]
    share = R("count(*)::DOUBLE / (SELECT count(*) FROM raw) * 100.0", 3)
    return RUNS_ONLY + f""", raw AS (SELECT line_no AS l FROM runs), f AS ({' UNION ALL '.join(rows)})
SELECT field, expected_type, found_type, count(*) AS records, {share} AS share_pct,
  NOT coalesce(found_type = expected_type, FALSE) AS drift
FROM f WHERE found_type IS NOT NULL GROUP BY field, expected_type, found_type"""


@register("dq_report_types", _types_sql())
def q_dq_report_types(t):
    """Type drift of raw JSON records, read as variants: a changed type, a new field and the rate of broken records."""
    line = F.col("line_no")
    duration = F.when(line != 7, F.col("duration_minutes").cast("double")).alias("duration_minutes")
    plain = [duration if c == "duration_minutes" else F.col(c) for c in TYPED]
    text = [F.col(c).cast("string").alias(c) if c == "rows_processed" else F.col(c) for c in TYPED]
    j = F.to_json(F.struct(*plain, F.when(line == 7, 1).alias("retries")))
    raw = fx.runs(t).select(F.when(line == 5, F.to_json(F.struct(*text)))
                            .when(line == 6, F.substr(j, F.lit(1), F.length(j) - 1)).otherwise(j).alias("value"))
    path = scratch_dir(t.spark, "raw-records")
    raw.write.text(path)
    return Q.type_report(Q.as_variant(t.spark.read.text(path)))


@register("dq_report_by_day", _dq_sql(DIRTY + ", src AS (SELECT *, CAST(start_time AS DATE) AS d FROM dirty)",
                                      RUN_COLS, [], by="d"))
def q_dq_report_by_day(t):
    """Q1-Q4 per run date: null rate and low volume per partition."""
    d = fx.dirty_runs(t).withColumn("run_date", F.to_date("start_time"))
    return _dq(d, by=["run_date"])


@register("dq_null_rates", DIRTY + ", " + ", ".join([]) + "src AS (SELECT * FROM dirty) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {R(f'count(*) FILTER (WHERE {c} IS NULL)::DOUBLE / count(*) * 100.0', 1)}"
    f" AS null_pct FROM src" for c in REQ))
def q_dq_null_rates(t):
    """Null rate per required column, one pass."""
    return Q.null_rates(fx.dirty_runs(t))


# ---- reconciliation ----------------------------------------------------------
def _recon_sql(tol: float) -> str:
    return f"""WITH o AS (SELECT o_orderkey, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m') AS period,
    o_totalprice AS amount FROM orders),
  d AS (SELECT * FROM o WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
  sc AS (SELECT period, count(*) AS c, sum(amount) AS a FROM o WHERE period <> '1996-02' GROUP BY period),
  dc AS (SELECT period, count(*) AS c, sum(amount) AS a FROM d GROUP BY period),
  j AS (SELECT coalesce(sc.period, dc.period) AS period, coalesce(sc.c, 0) AS s, coalesce(dc.c, 0) AS dd,
          coalesce(sc.a, 0.0) AS sa, coalesce(dc.a, 0.0) AS da FROM sc FULL OUTER JOIN dc ON sc.period = dc.period),
  k AS (SELECT *, CASE WHEN s > 0 THEN abs(s - dd)::DOUBLE / s * 100.0 ELSE 0.0 END AS pct FROM j)
SELECT period, s AS source_count, dd AS destination_count, abs(s - dd) AS diff, {R('pct', 4)} AS diff_pct,
  CASE WHEN pct > {tol} OR (s = 0 AND dd > 0) THEN 'MISMATCH' ELSE 'RECONCILED' END AS status,
  {R('sa', 2)} AS source_amount, {R('da', 2)} AS destination_amount FROM k"""


def _recon(t, tol):
    src, dst = fx.reconcile_sides(t)
    return RC.reconcile(src, dst, ["period"], tol_pct=tol, amount="amount")


@register("reconcile", _recon_sql(0.1))
def q_reconcile(t):
    """Per-month source vs destination counts, 0.1 % tolerance."""
    return _recon(t, 0.1)


@register("reconcile_2pct", _recon_sql(2.0))
def q_reconcile_2pct(t):
    """B1 with a 2 % tolerance."""
    return _recon(t, 2.0)


@register("reconcile_summary", "SELECT status, count(*) AS keys, sum(diff) AS total_diff FROM ("
          + _recon_sql(0.1) + ") GROUP BY status")
def q_reconcile_summary(t):
    """B1 summary: keys and total difference per status."""
    return RC.reconcile_summary(_recon(t, 0.1))


# ---- velocity ----------------------------------------------------------------
@register("velocity_batch", O.with_(O.TX) + """SELECT account_id, count(*) AS txn_count FROM tx GROUP BY account_id
  HAVING count(*) > 75""")
def q_velocity_batch(t):
    """Accounts over the batch threshold (75 here)."""
    return VL.velocity_batch(fx.transactions(t), 75)


@register("velocity_summary", O.with_(O.TX) + f"""SELECT count(*) AS total_accounts,
  count(*) FILTER (WHERE c > 75) AS flagged_count,
  {R('count(*) FILTER (WHERE c > 75)::DOUBLE / count(*) * 100.0', 3)} AS flag_rate_pct,
  75 AS threshold, 5 AS window_minutes FROM (SELECT account_id, count(*) AS c FROM tx GROUP BY account_id)""")
def q_velocity_summary(t):
    """Accounts, flagged accounts and flag rate."""
    return VL.velocity_summary(fx.transactions(t), 75)


def _trail_sql(minutes: int, thr: int) -> str:
    return O.with_(O.TX) + f"""SELECT account_id, txn_id, strftime(ts, {TSF}) AS ts, trailing_count FROM
  (SELECT *, count(*) OVER (PARTITION BY account_id ORDER BY epoch_us(ts)
      RANGE BETWEEN {minutes * 60_000_000} PRECEDING AND CURRENT ROW) AS trailing_count FROM tx)
  WHERE trailing_count > {thr}"""


@register("velocity_trailing", _trail_sql(60, 2))
def q_velocity_trailing(t):
    """More than 2 transactions in the trailing 60 minutes."""
    return VL.velocity_trailing(fx.transactions(t), 60, 2)


@register("velocity_trailing_4h", _trail_sql(240, 3))
def q_velocity_trailing_4h(t):
    """More than 3 transactions in the trailing 240 minutes."""
    return VL.velocity_trailing(fx.transactions(t), 240, 3)


# ---- summaries ---------------------------------------------------------------
HOURLY = """hourly AS (SELECT CAST(CAST(ts AS TIMESTAMP) AS DATE) AS date, hour(CAST(ts AS TIMESTAMP)) AS hour,
  count(*) AS transaction_volume, sum(value) AS total_value FROM events GROUP BY 1, 2)"""


@register("daily_summary", O.with_(HOURLY) + f"""SELECT strftime(date, '%Y-%m-%d') AS date,
  sum(transaction_volume) AS total_volume, {R('sum(total_value)', 2)} AS total_value,
  arg_max(hour, (transaction_volume, -hour)) AS peak_hour, CAST(trunc(avg(transaction_volume)) AS BIGINT)
  AS avg_hourly_volume FROM hourly GROUP BY date""")
def q_daily_summary(t):
    """A5: hourly volumes to a daily summary with the peak hour."""
    return SM.daily_summary(fx.hourly_volumes(t))


SHARE = f"""WITH tc AS (SELECT o_orderpriority AS payment_type, count(*) AS transaction_count FROM orders GROUP BY 1)
SELECT payment_type, transaction_count,
  {R('transaction_count::DOUBLE / (SELECT sum(transaction_count) FROM tc) * 100.0', 2)} AS share_pct FROM tc"""


@register("share_of_total", SHARE)
def q_share_of_total(t):
    """Share of each payment type in the total."""
    return SM.share_of_total(fx.type_counts(t), "payment_type", "transaction_count")


@register("share_ranked", "SELECT *, rank() OVER (ORDER BY transaction_count DESC) AS rank FROM (" + SHARE + ")")
def q_share_ranked(t):
    """Payment types ranked by count."""
    return SM.share_ranked(SM.share_of_total(fx.type_counts(t), "payment_type", "transaction_count"),
                           "transaction_count")


# ---- extract, joins, as-of -----------------------------------------------------
EXT = O.with_(O.SUP, O.RUNS, O.TASKS)


def _extract_sql(hours: int) -> str:
    return EXT + f""", now_t AS (SELECT max(start_date) AS t FROM ti),
  cut AS (SELECT ti.* FROM ti, now_t WHERE start_date >= now_t.t - to_hours({hours})
          AND state IN ('success', 'failed'))
SELECT dag_id AS job_name, run_id, strftime(start_date, {TSF}) AS start_time,
  {R('duration / 60.0', 4)} AS duration_minutes, state AS status, team, impact, sla_minutes, normal_rows
FROM cut JOIN known ON known.job_name = cut.dag_id WHERE duration IS NOT NULL"""


def _extract(t, hours):
    ti = fx.task_instances(t)
    as_of = ti.select(F.max("start_date")).scalar()
    return X.extract_runs(ti, fx.registry_known(t), as_of, hours)


@register("extract_runs_24h", _extract_sql(24))
def q_extract_runs_24h(t):
    """Last 24 h of completed task records of known jobs, in minutes."""
    return _extract(t, 24)


@register("extract_runs_90d", _extract_sql(90 * 24))
def q_extract_runs_90d(t):
    """S7 with a 90-day lookback."""
    return _extract(t, 90 * 24)


@register("extract_runs_newest", _extract_sql(90 * 24) + " ORDER BY start_date DESC, run_id DESC")
def q_extract_runs_newest(t):
    """The extract newest first, all rows."""
    return _extract(t, 90 * 24).orderBy(F.col("start_time").desc(), F.col("run_id").desc())


@register("join_enrich", EXT + """SELECT r.job_name, r.run_id, reg.team, reg.impact, reg.sla_minutes
  FROM runs r JOIN reg ON reg.job_name = r.job_name""")
def q_join_enrich(t):
    """Runs enriched from the registry."""
    r = fx.runs(t).select("job_name", "run_id")
    return X.enrich(r, fx.registry(t))


@register("join_semi_known", EXT + """SELECT job_name, count(*) AS runs FROM runs
  WHERE job_name IN (SELECT job_name FROM known) GROUP BY job_name""")
def q_join_semi_known(t):
    """Runs of registered jobs only (left semi join)."""
    return X.known_runs(fx.runs(t), fx.registry_known(t)).groupBy("job_name").agg(F.count(F.lit(1)).alias("runs"))


@register("asof_rows_processed", O.with_(O.SUP, O.RUNS, O.RESULTS, O.TASKS) + """,
  re AS (SELECT job_name, run_id, start_time + to_microseconds(CAST(duration_minutes * 60000000 AS BIGINT)) AS run_end
         FROM runs)
SELECT re.job_name, re.run_id, coalesce(res.rows_processed, reg.normal_rows) AS rows_processed
FROM re ASOF LEFT JOIN res ON re.job_name = res.job_name AND re.run_end >= res.recorded_at
LEFT JOIN reg ON reg.job_name = re.job_name""")
def q_asof_rows_processed(t):
    """Each run gets the latest result at or before its end, else normal_rows."""
    r = fx.runs(t).select("job_name", "run_id", "start_time", "duration_minutes")
    return X.attach_rows_processed(r, fx.results(t), fx.registry(t)).select("job_name", "run_id",
                                                                             "rows_processed")


# ---- scalar functions ------------------------------------------------------------
@register("fn_time_parts", O.with_(O.EV) + """SELECT event_id, year(ts) AS y, month(ts) AS mo, day(ts) AS d,
  hour(ts) AS h, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
  (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 60000000.0::DOUBLE AS minutes_into_day FROM ev""")
def q_fn_time_parts(t):
    """Date parts, ISO text and minutes between timestamps."""
    from runsight.functions import iso_ts, minutes_between
    e = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.select("event_id", F.year("ts").alias("y"), F.month("ts").alias("mo"), F.dayofmonth("ts").alias("d"),
                    F.hour("ts").alias("h"), iso_ts("ts").alias("iso"),
                    minutes_between("ts", F.date_trunc("day", "ts")).alias("minutes_into_day"))


@register("fn_json_props", O.with_(O.EV) + """SELECT event_id, pk AS k,
  CASE WHEN pk % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM ev""")
def q_fn_json_props(t):
    """JSON property extraction from events.props."""
    e = t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return e.select("event_id", "k", F.when(F.col("k") % 2 == 0, "even").otherwise("odd").alias("parity"))


@register("fn_rounding", RUNS_ONLY + f"""SELECT run_id, {R('duration_minutes / 7.0', 2)} AS r2,
  {R('rows_processed / 3.0', 3)} AS r3, {R('duration_minutes * 1.3', 0)} AS r0 FROM runs""")
def q_fn_rounding(t):
    """Half-even rounding after scaling (the reference's numpy rounding)."""
    r = fx.runs(t)
    return r.select("run_id", rnd(F.col("duration_minutes") / 7.0, 2).alias("r2"),
                    rnd(F.col("rows_processed") / 3.0, 3).alias("r3"),
                    rnd(F.col("duration_minutes") * 1.3, 0).alias("r0"))


@register("view_sla", O.with_(O.SUP, O.RUNS, "runs_t AS (SELECT * FROM runs)", O.metrics_cte(runs="runs_t")) + ", "
          + VG + ", " + HEALTH + " SELECT job_name, tightness_score, volume_growth, recommended_sla FROM h")
def q_view_sla(t):
    """The SLA page as Spark SQL over the gold view."""
    from runsight.plans.q_graph import _views
    from runsight.plans.views import page
    return page(_views(t), "sla")


@register("view_deadlines", "SELECT deadline_name, buffer_minutes, critical_jobs, risk_level FROM ("
          + _deadline_sql(False) + ")")
def q_view_deadlines(t):
    """The deadline page as Spark SQL over the gold view."""
    from runsight.plans.q_graph import _views
    from runsight.plans.views import page
    return page(_views(t), "deadlines")


@register("view_incidents", INC + f"""SELECT job_name, strftime(detected_at, {TSF}) AS detected_at,
  strftime(resolved_at, {TSF}) AS resolved_at, CASE WHEN resolved_at IS NOT NULL THEN 'resolved' ELSE 'open' END
  AS state FROM inc ORDER BY detected_at DESC, job_name LIMIT 20""")
def q_view_incidents(t):
    """The incident page over the registered incident table."""
    from runsight.plans.q_graph import _views
    from runsight.plans.views import page
    return page(_views(t), "incidents")


@register("silver_corrections", O.with_(O.SUP, O.RUNS, O.RESULTS, O.TASKS, """tj AS (
  SELECT * REPLACE (CASE WHEN state = 'failed' THEN 'success' ELSE state END AS state,
                    CASE WHEN state = 'failed' THEN duration + 60 ELSE duration END AS duration) FROM ti)""", f"""x AS (
  SELECT dag_id AS job_name, run_id, start_date AS start_time, {R('duration / 60.0', 4)} AS duration_minutes,
         state AS status, normal_rows
  FROM tj JOIN known ON known.job_name = tj.dag_id WHERE state IN ('success', 'failed') AND duration IS NOT NULL
    AND start_date >= (SELECT max(start_date) FROM ti) - INTERVAL 90 DAY)""") + f"""
SELECT x.job_name, x.run_id, strftime(start_time, {TSF}) AS start_time, duration_minutes, status,
  coalesce(res.rows_processed, x.normal_rows) AS rows_processed
FROM (SELECT *, start_time + to_microseconds(CAST(duration_minutes * 60000000 AS BIGINT)) AS run_end FROM x) x
ASOF LEFT JOIN res ON x.job_name = res.job_name AND x.run_end >= res.recorded_at""")
def q_silver_corrections(t):
    """Runs land, then a later extract brings the failed ones corrected, then the first extract is replayed."""
    from runsight.plans import pipeline
    from runsight.session import scratch_dir
    ti, silver = fx.task_instances(t), scratch_dir(t.spark, "silver-corrections")
    bad = F.col("state") == "failed"
    fixed = ti.withColumns({"duration": F.when(bad, F.col("duration") + 60).otherwise(F.col("duration")),
                            "state": F.when(bad, "success").otherwise(F.col("state"))})
    as_of = ti.select(F.max("start_date")).scalar()
    for records, later in ((ti, 0), (fixed, 1), (ti, 0)):
        at = as_of + F.make_dt_interval(hours=F.lit(later))
        out = pipeline.land_runs(records, fx.results(t), fx.registry_known(t), at, 90 * 24 + later, silver)
    return out.select("job_name", "run_id", "start_time", "duration_minutes", "status", "rows_processed")


@register("pipeline_end_to_end", O.with_(O.SUP, O.RUNS, O.RESULTS, O.TASKS, f"""x AS (
  SELECT dag_id AS job_name, run_id, start_date AS start_time, {R('duration / 60.0', 4)} AS duration_minutes,
         state AS status, known.team, impact, sla_minutes, normal_rows
  FROM ti JOIN known ON known.job_name = ti.dag_id WHERE state IN ('success', 'failed') AND duration IS NOT NULL)""",
    """xr AS (SELECT x.*, coalesce(res.rows_processed, x.normal_rows) AS rows_processed
  FROM (SELECT *, start_time + to_microseconds(CAST(duration_minutes * 60000000 AS BIGINT)) AS run_end FROM x) x
  ASOF LEFT JOIN res ON x.job_name = res.job_name AND x.run_end >= res.recorded_at)""",
    O.metrics_cte(runs="xr")) + """SELECT job_name, team, total_runs, avg_duration, p95_duration, avg_rows, latest_duration,
  latest_rows, verdict, priority_score FROM m""")
def q_pipeline_end_to_end(t):
    """Task records and results to silver and five gold tables, run twice: the second run adds no run."""
    from runsight.plans import pipeline
    from runsight.session import scratch_dir
    ti, out = fx.task_instances(t), scratch_dir(t.spark, "end-to-end")
    as_of = ti.select(F.max("start_date")).scalar()
    for _ in range(2):
        gold = pipeline.end_to_end(ti, fx.results(t), fx.registry_known(t), fx.infra_metrics(t), fx.ci_runs(t),
                                   fx.deadlines(t), as_of, 20 * 365 * 24, out, signals_as_of=fx.events_max_ts(t))
    return gold["gold_job_metrics"].select("job_name", "team", "total_runs", "avg_duration", "p95_duration", "avg_rows",
                                           "latest_duration", "latest_rows", "verdict", "priority_score")
