"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for every node of `links` (a, b): the component is its smallest node.

    Every round each node takes the smallest label among its neighbours' and then its label's own label, so that long
    chains halve. Labels are rows of a table throughout; a node with very many links is pre-aggregated before it moves.
    """
    both = written(links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")).where("node <> other").distinct())
    labels = written(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")))
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("other"), F.col("component").alias("seen")), "other").groupBy("node").agg(F.min("seen").alias("seen"))
        lower = labels.join(near, "node").select("node", F.least("component", "seen").alias("component"), F.col("component").alias("old"))
        lower = written(lower)
        ahead = lower.select(F.col("node").alias("component"), F.col("component").alias("further"))
        jumped = written(lower.join(ahead, "component", "left").select("node", F.coalesce("further", "component").alias("component"), "old"))
        labels = jumped.select("node", "component")
        if not jumped.where("component <> old").limit(1).count():
            return labels
    raise RuntimeError(f"labels still move after {rounds} rounds")
