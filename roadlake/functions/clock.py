"""Time helpers. Exact arithmetic stays in epoch microseconds (LONG)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp read as UTC, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def floor_to(value: Column, step: Column | int) -> Column:
    """The largest multiple of `step` at or below a LONG `value`."""
    step = F.lit(step).cast("long") if isinstance(step, int) else step
    return value - F.pmod(value, step)


def iso_us(text: Column) -> Column:
    """Epoch microseconds of ISO 8601 text ('Z', an offset, or none for the session's zone); null when unreadable."""
    return F.unix_micros(F.try_to_timestamp(text))
