"""Bench: headline operators at $BENCH_SF_DIR (default /root/testdata/sf0.1), local[$BENCH_CPUS].

The driver tables are first mapped to the product's inputs (run records,
registry, signals, transactions ...) and written once as silver parquet
(``setup_silver``, timed on its own), as a landed silver table would be.
Each headline operator then reads those tables and is executed fully
(``noop`` sink: every row computed, nothing collected), once to warm up and
once timed; the time includes any eager step (written intermediates).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import functions as F

    from runsight.operators import deadlines as D
    from runsight.operators import fingerprint as FP
    from runsight.operators import graph as G
    from runsight.operators import metrics as M
    from runsight.operators import quality as Q
    from runsight.operators import recon as RC
    from runsight.operators import sla as H
    from runsight.operators import summaries as SM
    from runsight.operators import velocity as VL
    from runsight.operators import verdicts as V
    from runsight.plans import pipeline
    from runsight.session import get_spark
    from runsight.sources import extract as X
    from runsight.sources import fixtures as fx
    from runsight.sources import signals as S

    spark = get_spark(cpus=cpus, app="runsight-bench")
    t = fx.Tables(spark, sf_dir)
    silver = tempfile.mkdtemp(prefix="runsight-bench-silver-")
    times: dict[str, float] = {}

    t0 = time.time()
    inputs = {"runs": fx.runs(t).drop("line_no"), "registry": fx.registry(t), "infra": fx.infra_metrics(t),
              "ci": fx.ci_runs(t), "deadlines": fx.deadlines(t), "txn": fx.transactions(t),
              "tasks": fx.task_instances(t), "results": fx.results(t), "hourly": fx.hourly_volumes(t)}
    for name, df in inputs.items():
        # a landed table has many files; the driver's tables are one row group each
        df.repartition(int(cpus)).write.mode("overwrite").parquet(f"{silver}/{name}")
    times["setup_silver"] = round(time.time() - t0, 3)
    tb = {name: spark.read.parquet(f"{silver}/{name}") for name in inputs}
    as_of_events = tb["infra"].select(F.max("ts")).scalar()
    src, dst = fx.reconcile_sides(t)

    def gold():
        return M.job_metrics(tb["runs"])

    headline = {
        "job_metrics": gold,
        "job_metrics_approx_p95": lambda: M.job_metrics(tb["runs"], p95="approx"),
        "gold_verdicts": lambda: V.gold_verdicts(gold()),
        "graph_closure": lambda: G.closure(G.edges(tb["registry"])),
        "fingerprint": lambda: FP.fingerprint(gold(), G.edges(tb["registry"]),
                                              S.infra_signals(tb["infra"], as_of_events, 720), tb["ci"],
                                              as_of_events),
        "sla_health": lambda: H.sla_health(tb["runs"], gold()),
        "deadline_risk": lambda: D.deadline_risk(gold(), tb["deadlines"], fx.DEADLINE_AS_OF),
        "replay_scores": lambda: M.replay_scores(tb["runs"]),
        "asof_rows_processed": lambda: X.attach_rows_processed(
            tb["runs"].select("job_name", "run_id", "start_time", "duration_minutes"), tb["results"],
            tb["registry"]),
        "extract_runs_90d": lambda: X.extract_runs(tb["tasks"], tb["registry"],
                                                   tb["tasks"].select(F.max("start_date")).scalar(), 90 * 24),
        "velocity_trailing": lambda: VL.velocity_trailing(tb["txn"], 60, 2),
        "reconcile": lambda: RC.reconcile(src, dst, ["period"], amount="amount"),
        "dq_report_by_day": lambda: Q.quality_report(tb["runs"].withColumn("run_date", F.to_date("start_time")),
                                                     by=["run_date"]),
        "daily_summary": lambda: SM.daily_summary(tb["hourly"]),
    }

    def run(name, build):
        build().write.format("noop").mode("overwrite").save()  # warm-up
        t1 = time.time()
        build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t1, 3)

    for name, build in headline.items():
        run(name, build)

    def whole_pipeline():
        out = tempfile.mkdtemp(prefix="runsight-bench-gold-")
        g = pipeline.run(tb["runs"], tb["registry"], tb["infra"], tb["ci"], tb["deadlines"], fx.DEADLINE_AS_OF,
                         out, infra_minutes=720)
        return pipeline.summary(g)
    run("pipeline_all_gold", whole_pipeline)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = round(sum(v for k, v in times.items() if k != "setup_silver"), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
