"""Signal validation: exclusion globs, ranges, plausible rate of change, and the diagnostics they leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.text import matches_any
from roadlake.operators.ordered import HOUR_US, chunked_fold

# Default bounds per signal.
DEFAULT_RANGES = {
    "EngineRPM": (0.0, 8000.0),
    "ThrottlePosition": (0.0, 100.0),
    "BrakePedalApplied": (0.0, 1.0),
    "VehicleSpeed": (0.0, 200.0),
    "CoolantTemp": (-40.0, 180.0),
    "IntakeAirTemp": (-40.0, 120.0),
    "AmbientTemp": (-60.0, 80.0),
    "EngineOilTemp": (-40.0, 200.0),
    "MassAirFlow": (0.0, 500.0),
    "TransmissionGear": (0.0, 8.0),
    "ProbeFrame": (0.0, 1.0),
}


def _per_signal(settings: dict[str, float], signal: Column) -> Column:
    """The configured number of a signal, null where none is set."""
    out = F.lit(None).cast("double")
    for name, number in settings.items():
        out = F.when(signal == name, F.lit(float(number))).otherwise(out)
    return out


def row_reason(ranges: dict[str, tuple[float, float]], exclude: tuple[str, ...] = ()) -> Column:
    """The checks that need only the row itself, in order: exclusion, then inclusive range."""
    signal, value = F.col("signal"), F.col("value")
    low = _per_signal({k: v[0] for k, v in ranges.items()}, signal)
    high = _per_signal({k: v[1] for k, v in ranges.items()}, signal)
    return F.when(matches_any(signal, exclude), "FILTER_REJECTED").when(
        low.isNotNull() & ~value.between(low, high), "RANGE_EXCEEDED"
    )


def _accept_within(limit_of: dict[str, float]):
    """Fold step: a value passes when it is within the limit of the last value that passed."""

    def step(rows, state):
        limit = limit_of[rows["signal"][0]]
        held = None if state is None else state["held"]
        passed = []
        for value in rows["value"].tolist():
            ok = held is None or abs(value - held) <= limit
            held = float(value) if ok else held
            passed.append(ok)
        return passed, {"held": held}

    return step


def check_rate(df: DataFrame, max_deltas: dict[str, float], keys: list[str], order: list[str], chunk: int = HOUR_US) -> DataFrame:
    """`ok` per row of the signals that have a limit; a refused value never becomes the reference."""
    limited = df.where(F.col("signal").isin(list(max_deltas)))
    return chunked_fold(limited, [*keys, "signal"], order, ["value"], _accept_within(max_deltas), "ok", "boolean", chunk)


def validate(
    df: DataFrame,
    ranges: dict[str, tuple[float, float]] | None = None,
    max_deltas: dict[str, float] | None = None,
    exclude: tuple[str, ...] = (),
    keys: tuple[str, ...] = ("session",),
    order: tuple[str, ...] = ("t_us", "event_id"),
    chunk: int = HOUR_US,
) -> DataFrame:
    """Every input row with `reason`, null for the ones that pass. Only rows with a rate limit are folded."""
    checked = df.withColumn("reason", row_reason(ranges if ranges is not None else DEFAULT_RANGES, exclude))
    if not max_deltas:
        return checked
    fit = checked.where(F.col("reason").isNull())
    rated = check_rate(fit, max_deltas, list(keys), list(order), chunk).where(~F.col("ok"))
    on = [*keys, "signal", *order]
    refused = rated.select(*on, F.lit("RATE_IMPLAUSIBLE").alias("_rate"))
    return checked.join(refused, on, "left").withColumn("reason", F.coalesce("reason", "_rate")).drop("_rate")


def drop_events(rejected: DataFrame, hop: str, sample: Column | None = None) -> DataFrame:
    """Diagnostics: every dropped probe, and real traffic only where the sampling predicate says so."""
    probe = F.col("probe.tracer_id") if "probe" in rejected.columns else F.lit(None).cast("string")
    emitted = probe.isNotNull() | (F.lit(False) if sample is None else F.coalesce(sample, F.lit(False)))
    return rejected.where(F.col("reason").isNotNull() & emitted).select(
        probe.alias("tracer_id"), F.lit(hop).alias("hop"), F.lit("dropped").alias("outcome"), "reason", "signal", "t_us"
    )


def compare_summaries(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Leaves of `expected` (path, value) that `actual` lacks or holds differently; extra actual leaves pass."""
    return (
        expected.alias("e")
        .join(actual.alias("a"), F.col("e.path") == F.col("a.path"), "left")
        .where(F.col("a.path").isNull() | ~F.col("a.value").eqNullSafe(F.col("e.value")))
        .select(
            F.col("e.path").alias("path"),
            F.col("e.value").alias("expected"),
            F.col("a.value").alias("actual"),
            F.when(F.col("a.path").isNull(), "missing").otherwise("different").alias("problem"),
        )
    )
