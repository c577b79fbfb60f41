"""Column helpers shared by all operators (JVM-side expressions only)."""

from runsight.functions.core import (  # noqa: F401
    rnd, minutes_between, iso_ts, impact_weight, safe_z, lit_ts, SEVERITY,
)
