"""Track centrelines from GeoJSON: geometry text to ordered points and measured segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions.geo import haversine_m

_LINE = "array<array<double>>"
_LINES = "array<array<array<double>>>"


def _points(coordinates: Column) -> Column:
    """[lon, lat, ...] positions to structs; positions with fewer than two numbers are skipped."""
    usable = F.filter(F.coalesce(coordinates, F.array().cast(_LINE)), lambda c: F.size(c) >= 2)
    return F.transform(usable, lambda c: F.struct(F.get(c, 1).alias("lat"), F.get(c, 0).alias("lon")))


def _joined(lines: Column) -> Column:
    """Lines end to end. Each later line gives all but its first point; the first is put in front where the ends differ."""
    parts = F.filter(F.transform(F.coalesce(lines, F.array().cast(_LINES)), _points), lambda p: F.size(p) > 0)
    empty = F.array().cast("array<struct<lat:double,lon:double>>")

    def append(done, line):
        tail = F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0)))
        meets = F.element_at(done, -1) == F.get(line, 0)
        return F.when(F.size(done) == 0, line).when(meets, F.concat(done, tail)).otherwise(F.concat(done, line))

    return F.aggregate(parts, empty, append)


def line_of(geometry: Column) -> Column:
    """Points of a LineString or MultiLineString geometry (JSON text); null for other types."""
    kind = F.get_json_object(geometry, "$.type")
    coordinates = F.get_json_object(geometry, "$.coordinates")
    return F.when(kind == "LineString", _points(F.from_json(coordinates, _LINE))).when(
        kind == "MultiLineString", _joined(F.from_json(coordinates, _LINES))
    )


def track_points(tracks: DataFrame) -> DataFrame:
    """`tracks` (track_id, name, geometry text) with `points`. A Feature is unwrapped; a FeatureCollection gives its
    first feature with two points or more; tracks without such a line are skipped; a missing name is made from the id.

    The line is exploded, not selected and filtered: a filter on it, here or later, would be moved below and parse the text again,
    once for every use of the points."""
    g = F.col("geometry")
    kind = F.get_json_object(g, "$.type")
    features = F.from_json(F.get_json_object(g, "$.features"), "array<struct<geometry:string>>")
    shapes = F.when(kind == "FeatureCollection", F.transform(features, lambda f: f["geometry"])).otherwise(
        F.array(F.when(kind == "Feature", F.get_json_object(g, "$.geometry")).otherwise(g))
    )
    lines = F.filter(F.transform(shapes, line_of), lambda line: F.coalesce(F.size(line) >= 2, F.lit(False)))
    name = F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.concat(F.lit("track-"), F.col("track_id").cast("string")))
    return tracks.select("track_id", name.alias("name"), F.explode(F.slice(lines, 1, 1)).alias("points"))


def track_segments(points: DataFrame) -> DataFrame:
    """One row per segment with its length and the arc length at its start, and the track's total length.

    The running length is folded inside the track's own array, so no window over segments is needed."""
    p = F.col("points")
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(p) - 2),
        lambda i: F.struct(
            i.alias("seq"), F.get(p, i)["lat"].alias("lat1"), F.get(p, i)["lon"].alias("lon1"),
            F.get(p, i + 1)["lat"].alias("lat2"), F.get(p, i + 1)["lon"].alias("lon2"),
            haversine_m(F.get(p, i)["lat"], F.get(p, i)["lon"], F.get(p, i + 1)["lat"], F.get(p, i + 1)["lon"]).alias("len_m"),
        ),
    )
    measured = points.where(F.size(p) >= 2).select("track_id", "name", pairs.alias("pairs"))
    lengths = F.transform("pairs", lambda s: s["len_m"])
    starts = F.aggregate(
        lengths, F.array(F.lit(0.0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    )
    with_starts = measured.select("track_id", "name", starts.alias("starts"), "pairs")
    rows = with_starts.select("track_id", "name", "starts", F.explode("pairs").alias("s"))
    return rows.select(
        "track_id", "name", "s.*", F.get("starts", F.col("s.seq")).alias("s_start_m"), F.element_at("starts", -1).alias("track_length_m")
    )


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON files, one track each, named by file."""
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.xxhash64("_metadata.file_name").alias("track_id"), F.regexp_replace("_metadata.file_name", r"\.(geo)?json$", "").alias("name"),
        F.col("value").alias("geometry"),
    )
