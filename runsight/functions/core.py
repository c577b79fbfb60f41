"""Scalar column helpers.

All of these build Catalyst expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's results.
# Impact weights: high 3, medium 2, low 1, anything else 1.
IMPACT_WEIGHTS = {"high": 3, "medium": 2, "low": 1}
# Severity rank used for the default verdict order (most urgent first).
SEVERITY = {"breached": 0, "at_risk": 1, "insufficient_data": 2, "safe": 3}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x, n: int) -> Column:
    """Round half to even after scaling, as numpy does: rint(x * 10^n) / 10^n.

    ``F.round`` rounds half up and ``F.bround`` rounds the decimal value; the
    scaled-rint form is what the reference computes and what DuckDB's
    ``round_even(x * 10^n, 0) / 10^n`` reproduces bit for bit.
    """
    s = float(10 ** n)
    # "+ 0.0" turns a rounded -0.0 into 0.0, so zero has one spelling.
    return F.rint(_c(x) * F.lit(s)) / F.lit(s) + F.lit(0.0)


def minutes_between(later, earlier) -> Column:
    """Minutes from ``earlier`` to ``later`` as a double (timestamps)."""
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / F.lit(60_000_000.0)


def iso_ts(x) -> Column:
    """ISO-8601 text of a timestamp, seconds precision (sink format)."""
    return F.date_format(_c(x), "yyyy-MM-dd'T'HH:mm:ss")


def impact_weight(x) -> Column:
    c = _c(x)
    return (F.when(c == "high", F.lit(IMPACT_WEIGHTS["high"]))
            .when(c == "medium", F.lit(IMPACT_WEIGHTS["medium"]))
            .otherwise(F.lit(1)))


def safe_z(value, mean, sd) -> Column:
    """(value - mean) / sd when sd > 0, else 0.0; NULL sd also gives 0.0."""
    sd = _c(sd)
    return F.when(sd > 0, (_c(value) - _c(mean)) / sd).otherwise(F.lit(0.0))


def lit_ts(as_of) -> Column:
    """A timestamp literal from a datetime or ISO string (UTC session)."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(str(as_of)))
