"""Window statistics, their guards and derived signals on a stream: chained aggregations, no state of our own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.operators.windows import Derived, WindowConfig, guard, setting

STATS = ["topic", "signal", "unit", "session", "window_start_us", "window_end_us", "sample_count", "min_value", "max_value", "mean_value", "stddev_value", "kind", "reason"]


def _lengths(config: WindowConfig) -> list[int]:
    return sorted({config.default_seconds, *config.seconds.values()})


def _of_length(routed: DataFrame, config: WindowConfig, seconds: int, delay: str, tie: str, only: Column | None = None) -> DataFrame:
    """Windows of the signals of one length. The condition names the event time, so that it stays above the watermark:
    every branch then moves with all traffic, also where its own signals are rare."""
    timed = routed.withColumn("event_time", F.timestamp_micros("t_us")).withWatermark("event_time", delay)
    wanted = F.when(F.col("event_time").isNotNull(), setting(config.seconds, config.default_seconds)) == seconds
    if only is not None:
        wanted = wanted & F.when(F.col("event_time").isNotNull(), only)
    first = F.struct("t_us", tie)
    stats = timed.where(wanted).groupBy("topic", "signal", F.window("event_time", f"{seconds} seconds").alias("w")).agg(
        F.min_by(F.struct("unit", "session"), first).alias("first_event"), F.count("value").alias("sample_count"), F.min("value").alias("min_value"),
        F.max("value").alias("max_value"), F.avg("value").alias("mean_value"), F.stddev_pop("value").alias("stddev_value"))
    return stats.withColumn("reason", guard(config))


def _edges(at: str) -> list:
    return [F.unix_micros(f"{at}.start").alias("window_start_us"), F.unix_micros(f"{at}.end").alias("window_end_us")]


def window_stream(routed: DataFrame, config: WindowConfig = WindowConfig(), delay: str = "5 seconds", tie: str = "event_id") -> DataFrame:
    """All windows as they close, kept or not, with `reason`: the rows of `window_stats`.

    `routed`: topic, signal, unit, session, value, t_us and `tie`. A window closes once event time is `delay` past its end;
    what comes later for it is dropped by the watermark. A built-in window has one length, so there is one aggregation for
    each distinct length of the configuration; all are combined before the shuffle, so a signal of a whole fleet
    arrives as one row per task and window."""
    parts = [
        _of_length(routed, config, seconds, delay, tie).select(
            "topic", "signal", "first_event.unit", "first_event.session", *_edges("w"), "sample_count", "min_value", "max_value", "mean_value", "stddev_value",
            F.lit("WINDOWED").alias("kind"), "reason")
        for seconds in _lengths(config)
    ]
    return reduce(DataFrame.unionByName, parts)


def derived_stream(routed: DataFrame, config: WindowConfig = WindowConfig(), delay: str = "5 seconds", tie: str = "event_id") -> DataFrame | None:
    """Derived rows from closed windows that the guards keep: a second aggregation over the first one's windows, by topic and
    window, which gives a row where every input is there. Inputs of different lengths never share a window."""
    parts = [part for d in config.derived if (part := _derived(routed, config, d, delay, tie)) is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _derived(routed: DataFrame, config: WindowConfig, d: Derived, delay: str, tie: str) -> DataFrame | None:
    lengths = {config.seconds.get(name, config.default_seconds) for name in d.inputs}
    if len(lengths) > 1:
        return None
    seconds = lengths.pop()
    kept = _of_length(routed, config, seconds, delay, tie, (F.col("topic") == d.topic) & F.col("signal").isin(list(d.inputs))).where("reason IS NULL")
    means = [F.max(F.when(F.col("signal") == n, F.col("mean_value"))).alias(n) for n in d.inputs]
    wide = kept.groupBy("topic", F.window("w", f"{seconds} seconds").alias("v")).agg(
        F.count("*").alias("present"), F.min("sample_count").alias("sample_count"), F.max(F.when(F.col("signal") == d.inputs[0], F.col("first_event.session"))).alias("session"), *means)
    value = F.expr(d.value).cast("double")
    return wide.where(F.col("present") == len(d.inputs)).select(
        "topic", F.lit(d.name).alias("signal"), F.lit(d.unit).alias("unit"), "session", *_edges("v"), "sample_count", value.alias("min_value"), value.alias("max_value"),
        value.alias("mean_value"), F.lit(0.0).alias("stddev_value"), F.lit("DERIVED").alias("kind"), F.lit(None).cast("string").alias("reason"))
