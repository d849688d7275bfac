"""The fixed signal profile of one car: raw frames to signal events, or a reason why not."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.bits import byte_at, word_of_hex

PROBE_ID = 0x7FF
PROBE_MAGIC = 0xCA
MAX_CAN_ID = 0x1FFFFFFF


@dataclass(frozen=True)
class ProfileSignal:
    """`value` is a SQL expression over b0..b7, the payload bytes."""

    can_id: int
    name: str
    unit: str
    min_dlc: int
    value: str


# The ten signals of the 2008 Impala profile.
IMPALA = (
    ProfileSignal(0x0C9, "EngineRPM", "rpm", 3, "(b1 * 256 + b2) * 0.25e0"),
    ProfileSignal(0x0C9, "ThrottlePosition", "percent", 5, "b4 / 2.55e0"),
    ProfileSignal(0x0C9, "BrakePedalApplied", "bool", 6, "b5 & 1"),
    ProfileSignal(0x3E9, "VehicleSpeed", "mph", 2, "(b0 * 256 + b1) * 0.01e0"),
    ProfileSignal(0x4C1, "CoolantTemp", "degC", 3, "b2 - 40"),
    ProfileSignal(0x4C1, "IntakeAirTemp", "degC", 4, "b3 - 40"),
    ProfileSignal(0x4C1, "AmbientTemp", "degC", 5, "b4 / 2.0e0 - 40"),
    ProfileSignal(0x4D1, "EngineOilTemp", "degC", 3, "b2 - 40"),
    ProfileSignal(0x1EF, "MassAirFlow", "g/s", 4, "(b2 * 256 + b3) / 100.0e0"),
    ProfileSignal(0x135, "TransmissionGear", "gear", 1, "b0"),
)


def frame_fault(frames: DataFrame) -> Column:
    """FRAME_INVALID for a frame outside the format's limits, else null."""
    bad = (
        ~F.col("dlc").between(0, 8)
        | ~F.col("can_id").between(0, MAX_CAN_ID)
        | (F.col("timestamp_ms") < 0)
        | (F.length("data_hex") < F.col("dlc") * 2)
    )
    return F.when(F.coalesce(bad, F.lit(True)), F.lit("FRAME_INVALID"))


def with_probe(frames: DataFrame) -> DataFrame:
    """Attach `probe` (tracer id, flow, suppress flag) to tracer frames; null elsewhere."""
    word = word_of_hex(F.col("data_hex"))
    is_probe = (F.col("can_id") == PROBE_ID) & (F.col("dlc") == 8) & (byte_at(word, 0) == PROBE_MAGIC)
    return frames.withColumn(
        "probe",
        F.when(
            is_probe,
            F.struct(
                F.lower(F.substring("data_hex", 3, 8)).alias("tracer_id"),
                byte_at(word, 5).cast("int").alias("flow_id"),
                F.col("timestamp_ms").alias("injected_ms"),
                (byte_at(word, 6).bitwiseAND(F.lit(1)) == 1).alias("suppress_egress"),
            ),
        ),
    )


def decode_profile(frames: DataFrame, profile: tuple[ProfileSignal, ...] = IMPALA) -> DataFrame:
    """One row per frame: `reason` (null when usable) and `events`, the array of decoded signals.

    The profile is configuration, so it becomes expressions on the frame itself: no join and no shuffle. One short
    signal fails the whole frame.
    """
    valid = with_probe(frames.withColumn("fault", frame_fault(frames))).withColumn("_w", word_of_hex(F.col("data_hex")))
    for i in range(8):
        valid = valid.withColumn(f"b{i}", byte_at(F.col("_w"), i))

    by_id: dict[int, list[ProfileSignal]] = {}
    for signal in profile:
        by_id.setdefault(signal.can_id, []).append(signal)

    def event(name, unit, value: Column) -> Column:
        return F.struct(F.lit(name).alias("signal"), F.lit(unit).alias("unit"), value.cast("double").alias("value"))

    events = F.when(F.col("probe").isNotNull(), F.array(event("ProbeFrame", "count", F.lit(1.0))))
    need = F.when(F.col("probe").isNotNull(), F.lit(0))
    for can_id, signals in by_id.items():
        events = events.when(F.col("can_id") == can_id, F.array(*[event(s.name, s.unit, F.expr(s.value)) for s in signals]))
        need = need.when(F.col("can_id") == can_id, F.lit(max(s.min_dlc for s in signals)))

    reason = (
        F.when(F.col("fault").isNotNull(), F.col("fault"))
        .when(need.isNull(), "UNKNOWN_CAN_ID")
        .when(F.col("dlc") < need, "DBC_DECODE_FAILED")
    )
    return valid.select(*[c for c in frames.columns], "probe", reason.alias("reason"), events.alias("events"))


def signal_events(decoded: DataFrame) -> DataFrame:
    """One row per signal of the usable frames. The reason decides inside the array rather than in a filter, which
    Catalyst would push below the decode and there evaluate the whole decode a second time."""
    kept = [c for c in decoded.columns if c not in ("reason", "events")]
    usable = F.when(F.col("reason").isNull(), F.col("events"))
    rows = decoded.select(*kept, F.posexplode_outer(usable).alias("signal_no", "e")).where("e IS NOT NULL")
    return rows.select(*kept, "signal_no", "e.signal", "e.unit", "e.value")
