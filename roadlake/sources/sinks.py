"""Record sets of the signal sinks, and writing them as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.functions.text import topic_domain

RAW_TOPIC = "signals.validated"


def _terminal(df: DataFrame, kind: str, sink: str) -> DataFrame:
    topic = F.lit(RAW_TOPIC) if kind == "raw" else F.col("topic")
    return df.where("probe IS NOT NULL").select(
        "probe.tracer_id", F.lit(sink).alias("sink_name"), F.lit("forwarded_to_sink").alias("outcome"), "signal",
        topic.alias("source_topic"), F.lit(kind).alias("record_kind"), "session",
        F.col("probe.suppress_egress").alias("egress_suppressed"),
    )


def sink_records(validated: DataFrame, aggregated: DataFrame, sink: str = "jsonl") -> dict[str, DataFrame]:
    """Raw, aggregate and terminal record sets. A probe leaves a terminal row; one that suppresses egress leaves
    only that."""
    sent = ~F.coalesce(F.col("probe.suppress_egress"), F.lit(False))
    raw = validated.where(sent).select("*", F.lit(RAW_TOPIC).alias("source_topic"))
    agg = aggregated.where(sent).select(
        "*", F.col("signal").alias("measurement"), topic_domain(F.col("topic")).alias("domain"), F.col("topic").alias("source_topic")
    )
    terminal = _terminal(validated, "raw", sink).unionByName(_terminal(aggregated, "aggregate", sink))
    return {"raw": raw, "aggregate": agg, "terminal": terminal}


def record_counts(records: dict[str, DataFrame]) -> DataFrame:
    """One row per record set with its size."""
    out = None
    for name, df in records.items():
        counted = df.agg(F.count("*").alias("records")).select(F.lit(name).alias("record_set"), "records")
        out = counted if out is None else out.unionByName(counted)
    return out


def write_json_lines(records: dict[str, DataFrame], path: str, mode: str = "append") -> None:
    names = {"raw": "validated-signals", "aggregate": "aggregated-signals", "terminal": "probe-terminal-events"}
    for name, df in records.items():
        df.write.mode(mode).json(f"{path}/{names[name]}")
