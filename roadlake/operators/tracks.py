"""Fixes to track positions, and lists of tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.geo import METRES_PER_DEGREE, haversine_km, planar_m, segment_fraction
from roadlake.functions.rounding import half_even, half_up
from roadlake.session import broadcast_if_measured

MAX_DISTANCE_M = 75.0
CELL_DEG = 0.002


def _cell(degrees: Column, cell: float) -> Column:
    return F.floor(degrees / F.lit(cell))


SEGMENT_BYTES = 256  # of one segment in a list, its name included


def segment_cells(segments: DataFrame, max_distance_m: float = MAX_DISTANCE_M, cell: float = CELL_DEG) -> DataFrame:
    """Segments listed under every grid cell a fix could match them from: one row per cell with its segments.

    `segments` carries `track_order`, the place of its track in the list. Of identical segments only the first can ever
    win, so copies of a track are dropped before the lists are built; a list is then bounded by how many different
    segments fit around one cell."""
    shape = ["lat1", "lon1", "lat2", "lon2"]
    others = [c for c in segments.columns if c not in shape]
    unique = segments.groupBy(*shape).agg(F.min_by(F.struct(*others), F.struct("track_order", "seq")).alias("o")).select(*shape, "o.*")
    pad_lat = F.lit(max_distance_m / METRES_PER_DEGREE)
    steepest = F.least(F.lit(89.0), F.greatest(F.abs("lat1"), F.abs("lat2")) + pad_lat * 2)
    pad_lon = pad_lat / F.cos(F.radians(steepest))
    reach = unique.select(
        F.struct(*segments.columns).alias("s"),
        F.explode(F.sequence(_cell(F.least("lat1", "lat2") - pad_lat, cell), _cell(F.greatest("lat1", "lat2") + pad_lat, cell))).alias("cell_lat"),
        F.least("lon1", "lon2").alias("_lo"), F.greatest("lon1", "lon2").alias("_hi"), pad_lon.alias("_pad"),
    ).select("s", "cell_lat", F.explode(F.sequence(_cell(F.col("_lo") - F.col("_pad"), cell), _cell(F.col("_hi") + F.col("_pad"), cell))).alias("cell_lon"))
    return reach.groupBy("cell_lat", "cell_lon").agg(F.collect_list("s").alias("near"))


def match_tracks(
    fixes: DataFrame, segments: DataFrame, max_distance_m: float = MAX_DISTANCE_M, cell: float = CELL_DEG
) -> DataFrame:
    """Fixes (with lat, lon) within reach of a track, with the nearest segment `m`; on equal distance the earlier track,
    then the earlier segment.

    A fix lies in one cell, so it meets one list and its nearest segment is found inside the row: fixes are neither
    multiplied nor shuffled when the cell table is small enough to broadcast, and joined by cell otherwise."""
    cells = broadcast_if_measured(segment_cells(segments, max_distance_m, cell), 32 + F.size("near") * SEGMENT_BYTES)
    placed = fixes.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "*", _cell(F.col("lat"), cell).alias("cell_lat"), _cell(F.col("lon"), cell).alias("cell_lon")
    )
    joined = placed.join(cells, ["cell_lat", "cell_lon"])

    # three passes over the list, so that every intermediate is computed once per candidate
    scaled = F.transform("near", lambda s: F.struct(
        s.alias("s"), (F.lit(METRES_PER_DEGREE) * F.cos(F.radians((s["lat1"] + s["lat2"] + F.col("lat")) / 3.0))).alias("k")))
    planar = F.transform(scaled, lambda c: F.struct(
        c["s"].alias("s"), ((c["s"]["lon2"] - c["s"]["lon1"]) * c["k"]).alias("bx"), ((c["s"]["lat2"] - c["s"]["lat1"]) * METRES_PER_DEGREE).alias("by"),
        ((F.col("lon") - c["s"]["lon1"]) * c["k"]).alias("px"), ((F.col("lat") - c["s"]["lat1"]) * METRES_PER_DEGREE).alias("py")))
    placed_on = F.transform(planar, lambda c: F.struct(
        c.alias("c"), segment_fraction(c["bx"], c["by"], c["px"], c["py"]).alias("t")))
    measured = F.transform(placed_on, lambda m: F.struct(
        F.hypot(m["c"]["px"] - m["t"] * m["c"]["bx"], m["c"]["py"] - m["t"] * m["c"]["by"]).alias("distance_m"),
        m["c"]["s"]["track_order"].alias("track_order"), m["c"]["s"]["seq"].alias("seq"), m["t"].alias("t"),
        (m["t"] * F.hypot(m["c"]["bx"], m["c"]["by"])).alias("along_m"), m["c"]["s"].alias("s")))
    best = joined.select(*fixes.columns, F.array_min(measured).alias("m"))
    return best.where(F.col("m.distance_m") <= max_distance_m)


def track_positions(fixes: DataFrame, segments: DataFrame, max_distance_m: float = MAX_DISTANCE_M) -> DataFrame:
    """Track position records: arc length, progress, distance to the line and the snapped point."""
    matched = match_tracks(fixes, segments, max_distance_m)
    s_m = F.col("m.s.s_start_m") + F.col("m.along_m")
    length = F.col("m.s.track_length_m")
    return matched.select(
        *fixes.columns, F.col("m.s.track_id").alias("track_id"), F.col("m.s.name").alias("track_name"), F.col("m.seq").alias("seq"),
        half_up(s_m).alias("s_m"), half_up(s_m / length * 100.0).alias("progress_pct"), half_up(F.col("m.distance_m")).alias("distance_to_track_m"),
        (F.col("m.s.lat1") + (F.col("m.s.lat2") - F.col("m.s.lat1")) * F.col("m.t")).alias("snapped_latitude"),
        (F.col("m.s.lon1") + (F.col("m.s.lon2") - F.col("m.s.lon1")) * F.col("m.t")).alias("snapped_longitude"),
        half_up(length).alias("track_length_m"),
    )


def track_centers(points: DataFrame) -> DataFrame:
    """Middle of each track's bounding box."""
    lat, lon = F.transform("points", lambda p: p["lat"]), F.transform("points", lambda p: p["lon"])
    return points.select(
        "track_id", "name", ((F.array_min(lat) + F.array_max(lat)) / 2).alias("center_lat"), ((F.array_min(lon) + F.array_max(lon)) / 2).alias("center_lon")
    )


def tracks_nearest_first(tracks: DataFrame, lat: float | None = None, lon: float | None = None) -> DataFrame:
    """Tracks by distance from a point (two decimals, unknown last, then name), or by name without one."""
    if lat is None or lon is None:
        return tracks.withColumn("distance_km", F.lit(None).cast("double")).orderBy(F.lower("name"))
    away = half_even(haversine_km(F.lit(lat), F.lit(lon), F.col("center_lat"), F.col("center_lon")), 2)
    return tracks.withColumn("distance_km", away).orderBy(F.col("distance_km").asc_nulls_last(), "name")


def session_list(positions: DataFrame, limit: int = 100) -> DataFrame:
    """Sessions with track positions, latest first."""
    grouped = positions.groupBy("session", "device", "track_id").agg(
        F.max("track_name").alias("track_name"), F.max("track_length_m").alias("track_length_m"),
        F.min("t_us").alias("started_us"), F.max("t_us").alias("ended_us"), F.count("*").alias("sample_count"),
    )
    return grouped.orderBy(F.col("ended_us").desc(), "session", "device", "track_id").limit(limit)


def nearest_route_point(points: DataFrame, keys: list[str], lat: float, lon: float, max_m: float, order: list[str]) -> DataFrame:
    """Per key, the point of the route nearest to (lat, lon) if it is within `max_m`; the earlier on a tie."""
    away = planar_m(F.col("lat"), F.col("lon"), F.lit(lat), F.lit(lon))
    near = points.withColumn("distance_m", away).where(F.col("distance_m") <= max_m)
    others = [c for c in near.columns if c not in keys]
    return near.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct("distance_m", *order)).alias("p")).select(*keys, "p.*")
