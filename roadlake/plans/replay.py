"""A recorded CAN log through decode, validation, routing, windows and sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.operators.ordered import HOUR_US, prev, scan
from roadlake.operators.profile import IMPALA, ProfileSignal, decode_profile, signal_events
from roadlake.operators.route import DEFAULT_RULES, Rule, route
from roadlake.operators.validate import validate
from roadlake.operators.windows import WindowConfig, aggregate
from roadlake.session import cut_lineage
from roadlake.sources.sinks import sink_records


@dataclass(frozen=True)
class Replay:
    """The stages of one replay, each a lazy DataFrame."""

    frames: DataFrame
    validated: DataFrame
    routed: DataFrame
    aggregated: DataFrame
    drops: DataFrame
    records: dict[str, DataFrame]

    def summary(self) -> DataFrame:
        """(path, value): counts per stage, drops per reason, records per sink."""

        def count(df: DataFrame, path: str) -> DataFrame:
            return df.agg(F.count("*").alias("value")).select(F.lit(path).alias("path"), "value")

        stages = {
            "frame_count": self.frames,
            "validated_events": self.validated,
            "routed_events": self.routed,
            "aggregated_events": self.aggregated,
            "diagnostics.count": self.drops,
            "sink_summary.raw_records_written": self.records["raw"],
            "sink_summary.aggregate_records_written": self.records["aggregate"],
            "sink_summary.terminal_events_recorded": self.records["terminal"],
        }
        out = self.drops.groupBy("reason").agg(F.count("*").alias("value")).select(
            F.concat(F.lit("diagnostics.reasons."), "reason").alias("path"), "value"
        )
        for path, df in stages.items():
            out = out.unionByName(count(df, path))
        return out


def replay_log(
    frames: DataFrame,
    profile: tuple[ProfileSignal, ...] = IMPALA,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    windows: WindowConfig = WindowConfig(),
    max_deltas: dict[str, float] | None = None,
    chunk: int = HOUR_US,
) -> Replay:
    """`frames`: session, event_id (total order within a millisecond), timestamp_ms, can_id, dlc, data_hex."""
    decoded = cut_lineage(decode_profile(frames, profile))  # every stage below is counted, so each is computed once
    stamped = signal_events(decoded).withColumn("t_us", F.col("timestamp_ms") * 1000)
    checked = cut_lineage(validate(stamped, max_deltas=max_deltas, order=("t_us", "event_id", "signal_no"), chunk=chunk))
    validated = checked.where("reason IS NULL").drop("reason")
    targets = cut_lineage(route(validated, rules))
    routed = targets.where("route_reason IS NULL").drop("route_reason")
    aggregated, short = aggregate(routed, windows)
    no_signal = F.lit(None).cast("string")
    drops = (
        decoded.where("reason IS NOT NULL").select(F.lit("ingest").alias("hop"), "reason", no_signal.alias("signal"))
        .unionByName(checked.where("reason IS NOT NULL").select(F.lit("validate").alias("hop"), "reason", "signal"))
        .unionByName(targets.where("route_reason IS NOT NULL").select(
            F.lit("router").alias("hop"), F.col("route_reason").alias("reason"), "signal"))
        .unionByName(short.select(F.lit("aggregate").alias("hop"), "reason", "signal"))
    )
    return Replay(frames, validated, routed, aggregated, drops, sink_records(validated, aggregated))


def out_of_order(frames: DataFrame, keys: list[str], order: list[str], time: str, chunk: int) -> DataFrame:
    """Frames earlier than the one before them in log order: a log that cannot be replayed in time."""
    before = scan(frames, keys, order, {"previous": prev(F.col(time))}, chunk)
    return before.where(F.col(time) < F.col("previous"))
