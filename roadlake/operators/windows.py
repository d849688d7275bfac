"""Windowed signal statistics, sample-count guards, derived signals and probe passthrough."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.clock import floor_to


@dataclass(frozen=True)
class Derived:
    """A signal computed from window means on one topic; `value` is SQL over the input names."""

    name: str
    topic: str
    inputs: tuple[str, ...]
    unit: str
    value: str


# The one derived signal defined by default.
LOAD_INDEX = Derived("PowertrainLoadIndex", "signals.powertrain", ("EngineRPM", "VehicleSpeed"), "rpm*mph", "EngineRPM * VehicleSpeed")


@dataclass(frozen=True)
class WindowConfig:
    default_seconds: int = 5
    seconds: dict[str, int] = field(default_factory=dict)
    min_samples: dict[str, int] = field(default_factory=dict)
    max_samples: dict[str, int] = field(default_factory=dict)
    derived: tuple[Derived, ...] = (LOAD_INDEX,)


DEFAULT_MIN_SAMPLES = 1

STATS = ["topic", "signal", "unit", "session", "window_start_us", "window_end_us", "sample_count", "min_value",
         "max_value", "mean_value", "stddev_value", "kind", "derived_from"]


def setting(values: dict[str, int], default: int | None) -> Column:
    """The configured number of a row's signal."""
    out = F.lit(default).cast("long")
    for name, number in values.items():
        out = F.when(F.col("signal") == name, F.lit(number).cast("long")).otherwise(out)
    return out


def guard(config: WindowConfig) -> Column:
    """Why a window of so many samples is not kept, null where it is."""
    return F.when(F.col("sample_count") > setting(config.max_samples, None), "WINDOW_OVERFLOW").when(
        F.col("sample_count") < setting(config.min_samples, DEFAULT_MIN_SAMPLES), "INSUFFICIENT_SAMPLES"
    )


def window_stats(routed: DataFrame, config: WindowConfig = WindowConfig(), tie: str = "event_id") -> DataFrame:
    """All windows, kept or not, with `reason`. Only signals named in `max_samples` have an upper limit: a window holds
    a whole fleet's samples, so its size says nothing by itself. The window length depends on the signal, so the start is computed
    rather than taken from a fixed window; the key has no session. Every aggregate merges map-side, so a hot
    signal reaches the shuffle as one row per task and window."""
    length = setting(config.seconds, config.default_seconds) * 1_000_000
    keyed = routed.select("topic", "signal", "unit", "session", "value", "t_us", tie, length.alias("length_us"))
    first = F.struct("t_us", tie)
    stats = (
        keyed.groupBy("topic", "signal", floor_to(F.col("t_us"), F.col("length_us")).alias("window_start_us"), "length_us")
        .agg(
            F.min_by(F.struct("unit", "session"), first).alias("first_event"),
            F.count("value").alias("sample_count"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.avg("value").alias("mean_value"),
            F.stddev_pop("value").alias("stddev_value"),
        )
    )
    return stats.select(
        "topic", "signal", "first_event.unit", "first_event.session", "window_start_us",
        (F.col("window_start_us") + F.col("length_us")).alias("window_end_us"),
        "sample_count", "min_value", "max_value", "mean_value", "stddev_value",
        F.lit("WINDOWED").alias("kind"), F.lit(None).cast("array<string>").alias("derived_from"), guard(config).alias("reason"),
    )


def derive(windows: DataFrame, definitions: tuple[Derived, ...]) -> DataFrame | None:
    """Derived rows: one pivoting aggregation per definition over the windows of its inputs, which emits a row only
    where every input has the same topic, start and end."""
    out = None
    for d in definitions:
        inputs = windows.where((F.col("topic") == d.topic) & F.col("signal").isin(list(d.inputs)))
        means = [F.max(F.when(F.col("signal") == n, F.col("mean_value"))).alias(n) for n in d.inputs]
        session = F.max(F.when(F.col("signal") == d.inputs[0], F.col("session"))).alias("session")
        wide = (
            inputs.groupBy("topic", "window_start_us", "window_end_us")
            .agg(F.count("*").alias("present"), F.min("sample_count").alias("sample_count"), session, *means)
            .where(F.col("present") == len(d.inputs))
            .withColumn("v", F.expr(d.value).cast("double"))
        )
        rows = wide.select(
            "topic", F.lit(d.name).alias("signal"), F.lit(d.unit).alias("unit"), "session", "window_start_us",
            "window_end_us", "sample_count", F.col("v").alias("min_value"), F.col("v").alias("max_value"),
            F.col("v").alias("mean_value"), F.lit(0.0).alias("stddev_value"), F.lit("DERIVED").alias("kind"),
            F.array(*[F.lit(n) for n in d.inputs]).alias("derived_from"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def passthrough(probes: DataFrame) -> DataFrame:
    """Probe events become zero-length windows of one sample."""
    return probes.select(
        "topic", "signal", "unit", "session", F.col("t_us").alias("window_start_us"), F.col("t_us").alias("window_end_us"),
        F.lit(1).cast("long").alias("sample_count"), F.col("value").alias("min_value"), F.col("value").alias("max_value"),
        F.col("value").alias("mean_value"), F.lit(0.0).alias("stddev_value"), F.lit("PROBE_PASSTHROUGH").alias("kind"),
        F.lit(None).cast("array<string>").alias("derived_from"), *(["probe"] if "probe" in probes.columns else []),
    )


def aggregate(routed: DataFrame, config: WindowConfig = WindowConfig(), tie: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """(aggregated, dropped windows). Rows whose `probe` is set pass through; the rest are windowed and derived from."""
    has_probe = "probe" in routed.columns
    real = routed.where("probe IS NULL") if has_probe else routed
    windows = window_stats(real, config, tie)
    kept = windows.where("reason IS NULL").select(*STATS)
    out = kept
    derived = derive(kept, config.derived)
    if derived is not None:
        out = out.unionByName(derived)
    if has_probe:
        probes = routed.where("probe IS NOT NULL")
        out = out.withColumn("probe", F.lit(None).cast(probes.schema["probe"].dataType)).unionByName(passthrough(probes))
    return out, windows.where("reason IS NOT NULL")
