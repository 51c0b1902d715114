"""Hour of an HHMMSS integer time (F1, F2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_hour(hhmmss: Column) -> Column:
    """F1: ROUND(t / 10000) in DOUBLE; minutes >= 50 round up (055000 -> 6.0)."""
    return F.round(hhmmss.cast("bigint") / F.lit(10000))


def clock_hour(hhmmss: Column) -> Column:
    """FLOOR(t / 10000), the clock hour, as BIGINT."""
    return F.floor(hhmmss.cast("bigint") / F.lit(10000)).cast("bigint")


def hour_of(hhmmss: Column, how: str = "round") -> Column:
    if how == "round":
        return rounded_hour(hhmmss)
    if how == "floor":
        return clock_hour(hhmmss)
    raise ValueError(f"how must be 'round' or 'floor', not {how!r}")
