"""Rounding and division rules."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_bin(x: Column, digits: int = 0) -> Column:
    """Round half away from zero on the binary value, as SQL warehouses do.

    ``F.round`` rounds the shortest decimal text instead and differs on ties such as 1.005.
    From 2**52 on a double has no fraction left to round.
    """
    scale = float(10**digits)
    scaled = F.abs(x.cast("double")) * scale
    whole = F.when(scaled < 2.0**52, F.floor(scaled + 0.5).cast("double")).otherwise(scaled)
    return F.signum(x) * whole / scale


def safe_div(a: Column, b: Column, alternate: float = 0.0) -> Column:
    """``a / b``, or the alternate result when b is zero or NULL."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(alternate))


def percent(part: Column, whole: Column) -> Column:
    return safe_div(part, whole) * 100.0
