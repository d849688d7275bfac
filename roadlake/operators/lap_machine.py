"""Laps by geofence: anchor, launch, crossings.

The state machine (no anchor, staged, lapping) is stated as relations. Anchors cut a session into epochs; an epoch's
launch is its first fix that passes the launch test; a lap ends at the first approach to the anchor at least the
minimum lap time after it began. Only that last choice is sequential, and it runs over the few fixes near the anchor.

Order of records with equal times: anchors, then IMU, then GPS, then `seq`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.geo import bearing_deg, bearing_delta, haversine_m
from roadlake.functions.rounding import half_up
from roadlake.operators.ordered import chunked_fold, last_known, prev, running_sum, scan
from roadlake.session import cut_lineage

KEY = ["session_key"]
ORDER = ["t_ms", "rank", "seq"]
HOUR_MS = 3_600_000


@dataclass(frozen=True)
class Profile:
    """The default device profile."""

    profile_id: str = "default"
    prefix: str = ""
    geofence_radius_m: float = 40.0
    bearing_tolerance_deg: float = 35.0
    min_lap_ms: int = 30_000
    launch_speed_kph: float = 3.0
    launch_accel: float = 2.5
    imu_staleness_ms: int = 2_000
    baseline_samples: int = 10
    has_imu: bool = True
    gravity_compensated: bool = False


def resolve_profile(device: Column, profiles: tuple[Profile, ...]) -> Column:
    """Id of the first profile whose prefix the device has, ignoring case; else the first profile; else the default."""
    out = F.lit(profiles[0].profile_id if profiles else Profile().profile_id)
    for p in reversed([p for p in profiles if p.prefix.strip()]):
        out = F.when(F.upper(device).startswith(p.prefix.upper()), p.profile_id).otherwise(out)
    return out


def session_key(session: Column, device: Column, header: Column | None = None) -> Column:
    """`session:device`; else the header's session; else unknown."""
    whole = F.when(session.isNotNull() & device.isNotNull(), F.concat(session, F.lit(":"), device))
    fallback = F.nullif(F.trim(header), F.lit("")) if header is not None else F.lit(None).cast("string")
    return F.coalesce(whole, fallback, F.lit("unknown"))


def _rank() -> Column:
    return F.when(F.col("kind") == "anchor", 0).when(F.col("kind") == "imu", 1).otherwise(2)


def _epochs(records: DataFrame, chunk: int) -> DataFrame:
    anchored = (F.col("kind") == "anchor") & F.col("lat").isNotNull() & F.col("lon").isNotNull()
    usable = (
        records.where(anchored | ((F.col("kind") == "imu") & F.col("magnitude").isNotNull())
                      | ((F.col("kind") == "gps") & F.col("lat").isNotNull() & F.col("lon").isNotNull()))
        .withColumn("rank", _rank())
    )
    numbered = scan(usable, KEY, ORDER, {"epoch": running_sum((F.col("kind") == "anchor").cast("long"))}, chunk)
    return cut_lineage(numbered.where(F.col("epoch") > 0))


def _launches(rows: DataFrame, p: Profile, chunk: int) -> DataFrame:
    """First fix of each epoch that passes the launch test, with its anchor."""
    is_imu = F.col("kind") == "imu"
    key = [*KEY, "epoch"]
    imu = F.when(is_imu, F.struct(F.col("magnitude").alias("m"), F.col("t_ms").alias("t")))
    seen = scan(rows, key, ORDER, {"imu_seen": running_sum(is_imu.cast("long")), "last_imu": last_known(imu)}, chunk)
    baseline = seen.where(is_imu & (F.col("imu_seen") <= p.baseline_samples)).groupBy(*key).agg(F.avg("magnitude").alias("baseline"))
    anchors = rows.where("kind = 'anchor'").groupBy(*key).agg(
        F.min_by(F.struct("lat", "lon"), F.struct(*ORDER)).alias("anchor")
    )
    fast = seen.where((F.col("kind") == "gps") & (F.col("speed") >= p.launch_speed_kph)).join(baseline, key, "left")
    fresh = F.col("t_ms") - F.col("last_imu.t") <= p.imu_staleness_ms
    if not p.has_imu:
        kicked = F.lit(True)
    elif p.gravity_compensated:
        kicked = fresh & (F.col("last_imu.m") >= p.launch_accel)
    else:
        kicked = fresh & (F.col("imu_seen") >= p.baseline_samples) & (F.abs(F.col("last_imu.m") - F.col("baseline")) >= p.launch_accel)
    first = fast.where(kicked).groupBy(*key).agg(
        F.min_by(F.struct("lat", "lon", "speed", *ORDER), F.struct(*ORDER)).alias("launch")
    )
    return anchors.join(first, key)


def _take_crossings(min_lap_ms: int):
    def step(rows, state):
        start = None if state is None else state["start"]
        taken = []
        for t, launched in zip(rows["t_ms"].tolist(), rows["launch_ms"].tolist()):
            begin = launched if start is None else start
            hit = t - begin >= min_lap_ms
            start = t if hit else begin
            taken.append(hit)
        return taken, {"start": start}

    return step


def laps(records: DataFrame, profile: Profile = Profile(), chunk: int = HOUR_MS) -> DataFrame:
    """Lap records of every session.

    `records`: session_key, t_ms, kind (anchor, imu, gps), seq, lat, lon, speed, magnitude."""
    key = [*KEY, "epoch"]
    rows = _epochs(records, chunk)
    launches = cut_lineage(_launches(rows, profile, chunk))
    at = F.struct(*ORDER)
    run = (
        rows.where("kind = 'gps'").join(launches, key)
        .where(at >= F.struct(*[F.col("launch")[c].alias(c) for c in ORDER]))
    )
    run = scan(run, key, ORDER, {"before": prev(F.struct("lat", "lon"))}, chunk).where("before IS NOT NULL")
    b, a, first = F.col("before"), F.col("anchor"), F.col("launch")
    heading = bearing_deg(b["lat"], b["lon"], F.col("lat"), F.col("lon"))
    launched_to = bearing_deg(a["lat"], a["lon"], first["lat"], first["lon"])
    near = (haversine_m(F.col("lat"), F.col("lon"), a["lat"], a["lon"]) <= profile.geofence_radius_m) & (
        bearing_delta(heading, launched_to) <= profile.bearing_tolerance_deg
    )
    moved = cut_lineage(run.select(
        *key, *ORDER, "speed", F.col("launch.t_ms").alias("launch_ms"), F.col("launch.speed").alias("launch_speed"), "anchor",
        haversine_m(b["lat"], b["lon"], F.col("lat"), F.col("lon")).alias("step_m"), near.alias("near"),
    ))
    crossings = chunked_fold(moved.where("near"), key, ORDER, ["launch_ms"], _take_crossings(profile.min_lap_ms), "crossed", "boolean", chunk)
    marked = moved.join(crossings.where("crossed").select(*key, *ORDER, "crossed"), [*key, *ORDER], "left")
    closes = F.coalesce("crossed", F.lit(False))
    in_lap = scan(marked.withColumn("closes", closes), key, ORDER, {"done": running_sum(closes.cast("long"), inclusive=False)}, chunk)
    numbered = in_lap.withColumn("lap_number", F.coalesce("done", F.lit(0)) + 1)
    # the fix that opens a lap gives it its first speed: the crossing that closed the lap before
    opening = F.when(F.col("closes"), F.struct((F.col("lap_number") + 1).alias("n"), F.lit(False).alias("own")))
    own = F.struct(F.col("lap_number").alias("n"), F.lit(True).alias("own"))
    spread = numbered.select(*key, *ORDER, "speed", "launch_ms", "launch_speed", "anchor", "step_m", "closes",
                             F.explode(F.filter(F.array(own, opening), lambda x: x.isNotNull())).alias("l"))
    mine = F.col("l.own")
    grouped = spread.groupBy(*key, F.col("l.n").alias("lap_number")).agg(
        F.max(F.when(~mine, F.col("t_ms"))).alias("opened_ms"), F.max("launch_ms").alias("launch_ms"), F.max("launch_speed").alias("launch_speed"),
        F.max(F.when(mine & F.col("closes"), F.col("t_ms"))).alias("lap_end_ms"), F.max("speed").alias("top"),
        F.sum(F.when(mine, F.col("step_m"))).alias("distance"), F.count_if(mine).alias("fixes"), F.first("anchor").alias("anchor"),
    ).where("lap_end_ms IS NOT NULL")
    start = F.coalesce("opened_ms", "launch_ms")
    first_lap = F.col("lap_number") == 1
    took = F.col("lap_end_ms") - start
    average = F.when(took > 0, (F.col("distance") / 1000.0) / (took / 3_600_000.0)).otherwise(0.0)
    return grouped.select(
        *key, "lap_number", start.alias("lap_start_ms"), "lap_end_ms", took.alias("lap_time_ms"),
        F.coalesce(F.when(first_lap, F.greatest("top", "launch_speed")).otherwise(F.col("top")), F.lit(0.0)).alias("max_speed_kph"),
        half_up(average, 1).alias("avg_speed_kph"), half_up(F.col("distance"), 1).alias("distance_m"),
        (F.col("fixes") + F.when(first_lap, 1).otherwise(0)).alias("gps_point_count"),
        F.col("anchor.lat").alias("anchor_lat"), F.col("anchor.lon").alias("anchor_lon"), F.lit(profile.profile_id).alias("profile_id"),
    )
