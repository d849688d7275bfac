"""Routing of signals to topics by glob rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.functions.text import matches_any


@dataclass(frozen=True)
class Rule:
    id: str
    patterns: tuple[str, ...]
    topics: tuple[str, ...]


# The default routing table, version 1.
DEFAULT_RULES = (
    Rule(
        "route-powertrain-primary",
        ("Engine*", "Throttle*", "Transmission*", "MassAirFlow", "CoolantTemp", "EngineOilTemp", "IntakeAirTemp"),
        ("signals.powertrain",),
    ),
    Rule("route-speed-to-powertrain", ("VehicleSpeed",), ("signals.powertrain",)),
    Rule("route-chassis-primary", ("VehicleSpeed", "BrakePedalApplied"), ("signals.chassis",)),
)


def route(
    df: DataFrame,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    table_version: int = 1,
    signal_versions: dict[str, int] | None = None,
) -> DataFrame:
    """Fan every signal out to its topics, one row per (rule, topic) that matches. Rows without a route stay, once,
    with `reason` set and no topic. The rules are configuration: they compile to one expression, not a join."""
    targets = F.array(
        *[
            F.struct(matches_any(F.col("signal"), r.patterns).alias("hit"), F.lit(r.id).alias("rule_id"), F.lit(t).alias("topic"))
            for r in rules
            for t in r.topics
        ]
    )
    required = F.lit(1)
    for name, version in (signal_versions or {}).items():
        required = F.when(F.col("signal") == name, F.lit(version)).otherwise(required)
    outdated = F.lit(table_version) < required
    hits = F.when(~outdated, F.filter(targets, lambda t: t["hit"]))
    reason = F.when(outdated, "ROUTING_TABLE_VERSION_MISMATCH").when(F.col("target").isNull(), "NO_ROUTE")
    return df.select("*", F.explode_outer(hits).alias("target")).select(
        *df.columns, F.col("target.rule_id").alias("rule_id"), F.col("target.topic").alias("topic"), reason.alias("route_reason")
    )
