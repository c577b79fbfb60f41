"""Counts stated in FIXTURES.md section 3 (an independent probe), checked on the Spark side at sf0.01."""

from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def counts(df, col):
    return {r[col]: r["n"] for r in df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).collect()}


def test_verdicts_growth_and_graph(spark):
    q = E.queries()
    assert counts(q["verdicts"](spark, SF), "verdict") == {"safe": 85, "at_risk": 4, "breached": 11}
    assert counts(q["volume_growth"](spark, SF), "volume_growth") == {"growing": 7, "stable": 86, "shrinking": 7}
    assert q["registry_edges"](spark, SF).count() == 105
    c = q["graph_closure"](spark, SF)
    assert c.count() == 950 and c.agg(F.max("hops")).first()[0] == 17


def test_fingerprint_classes(spark):
    q = E.queries()
    quiet = counts(q["fingerprint_quiet"](spark, SF), "fingerprint_type")
    assert quiet == {"data_quality_issue": 2, "cascade_failure": 5, "volume_spike": 1, "logic_bug": 7}
    noisy = counts(q["fingerprint_noisy"](spark, SF), "fingerprint_type")
    assert noisy == {"data_quality_issue": 2, "infrastructure_issue": 13}
