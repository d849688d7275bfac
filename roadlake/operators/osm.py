"""Track candidates from map elements: grouping ways, connecting them by shared nodes, stitching, import checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.session import cut_lineage

PIT_ROLE = "pit_lane"


def connected_ways(edges: DataFrame) -> DataFrame:
    """(way_id, component): ways joined through shared nodes, labelled by the smallest id.

    `edges`: way_id, node_id. Labels flow way to node to way by grouped minima, never as pairs of ways, and every round
    also follows the label's own label, so long chains need few rounds. Each round is checkpointed."""
    edges = cut_lineage(edges.select("way_id", "node_id").distinct())
    labels = cut_lineage(edges.groupBy("way_id").agg(F.col("way_id").alias("component")).distinct())
    while True:
        at_node = edges.join(labels, "way_id").groupBy("node_id").agg(F.min("component").alias("c"))
        spread = edges.join(at_node, "node_id").groupBy("way_id").agg(F.min("c").alias("component"))
        jump = spread.select(F.col("way_id").alias("component"), F.col("component").alias("_root"))
        moved = spread.join(jump, "component", "left").select("way_id", F.least("component", "_root").alias("component"))
        moved = cut_lineage(moved)
        changed = moved.alias("a").join(labels.alias("b"), "way_id").where("a.component <> b.component")
        stable = changed.isEmpty()
        labels = moved
        if stable:
            return labels


def track_candidates(relations: DataFrame, ways: DataFrame) -> DataFrame:
    """(candidate, name, relation_id, way_id) rows. Relations give their member ways without pit lanes; other ways are
    grouped by name, those named after a pit are dropped, and unnamed ones by connection.

    `relations`: relation_id, name, alt_name, members array<struct<type, ref, role>>; `ways`: way_id, name, nodes."""
    members = relations.select("relation_id", "name", "alt_name", F.explode("members").alias("m")).where(
        (F.col("m.type") == "way") & (F.coalesce("m.role", F.lit("")) != PIT_ROLE)
    )
    label = F.coalesce(_text("name"), _text("alt_name"), F.concat(F.lit("OSM Relation "), F.col("relation_id").cast("string")))
    known = members.select("relation_id", label.alias("name"), F.col("m.ref").alias("way_id")).join(ways.select("way_id"), "way_id")
    from_relations = known.select(
        F.concat(F.lit("relation:"), F.col("relation_id").cast("string")).alias("candidate"), "name", "relation_id", "way_id"
    )
    alone = ways.join(known.select("way_id").distinct(), "way_id", "left_anti").withColumn("name", _text("name"))
    none = F.lit(None).cast(relations.schema["relation_id"].dataType)
    named = alone.where(F.col("name").isNotNull() & ~F.lower("name").contains("pit")).select(
        F.concat(F.lit("name:"), "name").alias("candidate"), "name", none.alias("relation_id"), "way_id"
    )
    unnamed = alone.where(F.col("name").isNull())
    groups = connected_ways(unnamed.select("way_id", F.explode("nodes").alias("node_id")))
    lonely = unnamed.where(F.coalesce(F.size("nodes"), F.lit(0)) <= 0).select("way_id", F.col("way_id").alias("component"))
    connected = groups.unionByName(lonely).select(
        F.concat(F.lit("unnamed:"), F.col("component").cast("string")).alias("candidate"), F.lit("Unnamed track").alias("name"),
        none.alias("relation_id"), "way_id",
    )
    return from_relations.unionByName(named).unionByName(connected)


def _text(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


KEY = ["candidate", "way_id", "side"]


def _ranked(ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pointer doubling over the ends of ways. `ends`: candidate, way_id, side (the end at which a way is left), next_way and
    next_side (the way that follows, and the end at which that one is left; null at the end of a line).

    Each round every end still under way takes over what the end it has reached knows, so a line of n ways takes log n
    rounds of one join. Returns the ends that have found the end of their line, with the number of ways passed and
    the smallest way met (with the side it was left at), and those that never will, because their line is a ring."""
    none = F.col("next_way").isNull()
    here, there = F.struct("way_id", "side"), F.struct(F.col("next_way").alias("way_id"), F.col("next_side").alias("side"))
    states = ends.select(*KEY, "next_way", "next_side", F.when(none, here).otherwise(there).alias("at"), F.when(none, 0).otherwise(1).cast("long").alias("passed"),
                         F.when(none, here).otherwise(F.least(here, there)).alias("least"), none.alias("done"), F.lit(True).alias("lower"))
    states, before = cut_lineage(states), None
    while True:
        left = states.where("NOT done").agg(F.count("*").alias("n"), F.count_if("lower").alias("lower")).first()
        if not left["n"] or (left["n"] == before and not left["lower"]):
            return states.where("done").drop("at", "done", "lower"), states.where("NOT done").select(*KEY, "next_way", "next_side", "least")
        before = left["n"]
        reached = states.select("candidate", F.struct("way_id", "side").alias("at"), F.col("at").alias("_at"), F.col("passed").alias("_passed"), F.col("least").alias("_least"), F.col("done").alias("_done"))
        moved = states.where("NOT done").join(reached, ["candidate", "at"]).select(
            *KEY, "next_way", "next_side", F.col("_at").alias("at"), (F.col("passed") + F.col("_passed")).alias("passed"), F.least("least", "_least").alias("least"), F.col("_done").alias("done"),
            (F.col("_least") < F.col("least")).alias("lower"))
        states = cut_lineage(states.where("done").unionByName(moved))


def stitched_ways(ways: DataFrame) -> DataFrame:
    """(candidate, way_id, line_id, rank, reverse): the line of each way, its place there from 0, and whether the line runs
    against the way. `ways`: candidate, way_id, line (array of lat, lon).

    Ways are joined where exactly two ends of different ways of a candidate meet. A line is named after its smallest way and
    runs in that way's direction; a ring begins at that way's first point. Work is by way, never by candidate or line, so
    a name on a third of all ways takes as many tasks as any other ways. Ways of fewer than two points are left out,
    a way that is listed twice counts once."""
    usable = ways.where((F.size("line") >= 2) & F.col("candidate").isNotNull()).select("candidate", "way_id", F.col("line")[0].alias("first"), F.element_at("line", -1).alias("last")).dropDuplicates(["candidate", "way_id"])
    ends = cut_lineage(usable.select("candidate", "way_id", F.posexplode(F.array("first", "last")).alias("side", "point")))
    one = F.struct("way_id", "side")
    met = ends.groupBy("candidate", "point").agg(F.count("*").alias("n"), F.min(one).alias("a"), F.max(one).alias("b")).where("n = 2 AND a.way_id <> b.way_id")
    pairs = met.select("candidate", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"))
    follows = pairs.select("candidate", "p.a.way_id", "p.a.side", F.col("p.b.way_id").alias("next_way"), (1 - F.col("p.b.side")).alias("next_side"))
    linked = ends.select(*KEY).join(follows, KEY, "left")
    open_lines, rings = _ranked(linked)
    smallest = F.col("least.way_id")
    cut = ((F.col("way_id") == smallest) & (F.col("side") == 0)) | ((F.col("next_way") == smallest) & (F.col("next_side") == 1))
    opened = rings.select(*KEY, *[F.when(~cut, F.col(c)).alias(c) for c in ("next_way", "next_side")])
    lines = open_lines if rings.isEmpty() else open_lines.unionByName(_ranked(opened)[0])
    by_side = lines.groupBy("candidate", "way_id").agg(*[F.max(F.when(F.col("side") == k, F.struct("passed", "least"))).alias(f"s{k}") for k in (0, 1)])
    ahead = F.col("s1.least.way_id") <= F.col("s0.least.way_id")  # the line's smallest way is met going on from the last point
    line_id = F.least("s0.least.way_id", "s1.least.way_id")
    reverse = F.when(ahead, F.col("s1.least.side") == 0).otherwise(F.col("s0.least.side") == 1)
    return by_side.select("candidate", "way_id", line_id.alias("line_id"), F.when(reverse, F.col("s1.passed")).otherwise(F.col("s0.passed")).alias("rank"), reverse.alias("reverse"))


def stitch(ways: DataFrame) -> DataFrame:
    """The points of every line of each candidate, in order: (candidate, line_id, rank, point, lat, lon), a row per point, where
    `rank` and `point` order a line. The point at which two ways meet comes once. See `stitched_ways`."""
    placed = stitched_ways(ways).join(ways.where("size(line) >= 2").select("candidate", "way_id", "line").dropDuplicates(["candidate", "way_id"]), ["candidate", "way_id"])
    points = placed.withColumn("line", F.when(F.col("reverse"), F.reverse("line")).otherwise(F.col("line"))).select("candidate", "line_id", "rank", F.posexplode("line").alias("point", "p"))
    return points.where("rank = 0 OR point > 0").select("candidate", "line_id", "rank", "point", "p.lat", "p.lon")


def lines(points: DataFrame) -> DataFrame:
    """One row per line with its points as an array, for lines that fit a row: (candidate, line_id, line)."""
    grouped = points.groupBy("candidate", "line_id").agg(F.array_sort(F.collect_list(F.struct("rank", "point", "lat", "lon"))).alias("p"))
    return grouped.select("candidate", "line_id", F.transform("p", lambda x: F.struct(x["lat"].alias("lat"), x["lon"].alias("lon"))).alias("line"))


def import_check(candidates: DataFrame, tracks: DataFrame) -> DataFrame:
    """One row per candidate with `reason` when it is already a track: its relation is, or one of its ways is.

    `candidates` as from `track_candidates`; `tracks`: relation_id, way_ids. Way overlap is an equi-join on exploded
    ids, reduced to the list of shared ids per candidate."""
    relations = tracks.where(F.col("relation_id").isNotNull()).select("relation_id", F.lit(True).alias("_rel")).distinct()
    taken = tracks.select(F.explode("way_ids").alias("way_id"), F.lit(True).alias("_way")).distinct()
    joined = candidates.join(relations, "relation_id", "left").join(taken, "way_id", "left")
    by_way = F.col("relation_id").isNull() & F.col("_way")
    grouped = joined.groupBy("candidate", "name", "relation_id").agg(
        F.bool_or(F.coalesce("_rel", F.lit(False))).alias("_rel"), F.sort_array(F.collect_set(F.when(by_way, F.col("way_id")))).alias("_ways")
    )
    reason = F.when(
        F.col("_rel"), F.concat(F.lit("OSM relation "), F.col("relation_id").cast("string"), F.lit(" already imported"))
    ).when(F.size("_ways") > 0, F.concat(F.lit("Way IDs ["), F.array_join(F.col("_ways").cast("array<string>"), ", "), F.lit("] already imported")))
    return grouped.select("candidate", "name", "relation_id", reason.alias("reason"), reason.isNotNull().alias("already_imported"))
