"""Recording sessions: roll-up of their messages, derived state, lists, work queue, catch-up, deletion, devices, lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.rounding import half_even

KEYS = ["session", "device"]
MINUTE_US = 60_000_000

# Silence that ends a session, quiet before a summary, silence while recording, metrics version.
UNTERMINATED_US = 30 * MINUTE_US
QUIET_US = 2 * MINUTE_US
RECORDING_US = 5 * MINUTE_US
SUMMARY_VERSION = 3

START_FIELDS = ["mode", "vehicle_id", "track_id", "started_us"]
END_FIELDS = ["ended_us", "end_reason", "frames_expected", "first_frame_us", "last_frame_us"]


def roll_up(records: DataFrame, tracks: DataFrame | None = None) -> DataFrame:
    """Session messages to one row per session.

    `records`: keys, arrival (total order), message_type, user_sub, the start and end fields, base_us, received_us.
    The latest start and end win; a user once known is kept; a frame counts once per base, by its first arrival.
    Frames are reduced per base before they meet their session, so a long session is two partial aggregations."""
    kind = F.col("message_type")
    known = records.where(kind.isin("session_start", "session_end", "frame"))
    is_frame = kind == "frame"
    base = F.when(is_frame, F.col("base_us"))
    partial = known.groupBy(*KEYS, base.alias("base")).agg(
        F.max_by(F.struct(*START_FIELDS), F.when(kind == "session_start", F.col("arrival"))).alias("start"),
        F.max(F.when(kind == "session_start", F.col("arrival"))).alias("start_at"),
        F.max_by(F.struct(*END_FIELDS), F.when(kind == "session_end", F.col("arrival"))).alias("end"),
        F.max(F.when(kind == "session_end", F.col("arrival"))).alias("end_at"),
        F.max_by("user_sub", F.when(F.col("user_sub").isNotNull(), F.col("arrival"))).alias("user_sub"),
        F.max(F.when(F.col("user_sub").isNotNull(), F.col("arrival"))).alias("user_at"),
        F.min_by("received_us", "arrival").alias("received_us"),
        F.count("*").alias("n"),
    )
    counted = F.col("base").isNotNull()
    rolled = partial.groupBy(*KEYS).agg(
        F.max_by("start", "start_at").alias("start"), F.max_by("end", "end_at").alias("end"), F.max_by("user_sub", "user_at").alias("user_sub"),
        F.count("base").alias("frames_received"),
        F.sum(F.when(counted, F.col("n") - 1).otherwise(0)).alias("duplicates"),
        F.max(F.when(counted, F.col("received_us"))).alias("last_frame_received_us"),
    )
    out = rolled.select(
        *KEYS, "user_sub", *[F.col(f"start.{c}").alias(c) for c in START_FIELDS], *[F.col(f"end.{c}").alias(c) for c in END_FIELDS],
        "frames_received", "duplicates", "last_frame_received_us",
    )
    return out if tracks is None else known_tracks(out, tracks)


def known_tracks(sessions: DataFrame, tracks: DataFrame) -> DataFrame:
    """A track id the registry does not have becomes null."""
    ids = tracks.select(F.col("track_id").alias("_track")).distinct()
    joined = sessions.join(ids, F.col("track_id") == F.col("_track"), "left")
    return joined.withColumn("track_id", F.col("_track")).drop("_track")


def completeness_pct() -> Column:
    """Share of the expected frames received, capped at 100; 100 when none were expected, null when unknown."""
    expected, got = F.col("frames_expected"), F.col("frames_received")
    share = half_even(F.least(got, expected) * F.lit(100.0) / F.nullif(expected, F.lit(0)), 1)
    return F.when(expected == 0, 100.0).otherwise(share)


def state(now_us: Column) -> Column:
    """open, unterminated, complete or incomplete, seen from `now_us`."""
    heard = F.greatest("last_frame_received_us", "started_us")
    enough = F.coalesce(F.col("frames_received") >= F.col("frames_expected"), F.lit(False))
    return (
        F.when(F.col("ended_us").isNotNull(), F.when(enough, "complete").otherwise("incomplete"))
        .when(heard.isNull() | (now_us - heard > UNTERMINATED_US), "unterminated")
        .otherwise("open")
    )


def listing(sessions: DataFrame, vehicles: DataFrame, summaries: DataFrame) -> DataFrame:
    """Sessions with their vehicle's name and summary headline, both optional."""
    headline = summaries.select(
        *KEYS, "distance_km", "duration_s", F.coalesce("max_can_kph", "max_gps_kph").alias("max_kph")
    )
    return sessions.join(vehicles.select("vehicle_id", "vehicle_name"), "vehicle_id", "left").join(headline, KEYS, "left")


def page(listed: DataFrame, user: str, now_us: Column, limit: int = 30, offset: int = 0) -> DataFrame:
    """One page of an account's sessions, newest first."""
    mine = listed.where(F.col("user_sub") == user)
    ordered = mine.orderBy(F.col("started_us").desc_nulls_last(), F.col("session").desc(), F.col("device").desc())
    shown = ordered.offset(offset).limit(limit)
    return shown.withColumn("state", state(now_us)).withColumn("completeness_pct", completeness_pct())


def pending_summaries(sessions: DataFrame, summaries: DataFrame, now_us: Column) -> DataFrame:
    """Finished, quiet sessions whose summary is missing, of an older version, or built from other frames."""
    s = summaries.select(*KEYS, F.col("version").alias("_version"), F.col("frames_received").alias("_frames"))
    last = F.col("last_frame_received_us")
    finished = F.col("ended_us").isNotNull() | (last < now_us - UNTERMINATED_US)
    quiet = last.isNull() | (last < now_us - QUIET_US)
    stale = F.col("_version").isNull() | (F.col("_version") < SUMMARY_VERSION) | (F.col("_frames") != F.col("frames_received"))
    return sessions.where(finished & quiet).join(s, KEYS, "left").where(stale).drop("_version", "_frames")


def missing_frames(logged: DataFrame, received: DataFrame) -> DataFrame:
    """Logged frames that never arrived, each second once, oldest first within a session."""
    fresh = logged.join(received.select(*KEYS, "base_us"), [*KEYS, "base_us"], "left_anti").dropDuplicates([*KEYS, "base_us"])
    return fresh.orderBy(*KEYS, "base_us")


def still_recording(now_us: Column) -> Column:
    return F.col("ended_us").isNull() & F.coalesce(now_us - F.col("last_frame_received_us") < RECORDING_US, F.lit(False))


def without_sessions(rows: DataFrame, doomed: DataFrame, sessions: DataFrame, now_us: Column) -> DataFrame:
    """`rows` without those of the doomed sessions; sessions still recording are refused and stay."""
    allowed = doomed.join(sessions.where(~still_recording(now_us)), KEYS, "left_semi")
    return rows.join(allowed.select(*KEYS), KEYS, "left_anti")


def device_roll_up(heartbeats: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per device: first and last seen, owner (the first known account it published as, never moved), conflicts."""
    known = heartbeats.join(accounts.select("user_sub", F.lit(True).alias("_known")), "user_sub", "left")
    as_user = F.when(F.col("_known"), F.col("user_sub"))
    at = F.struct("t_us", "arrival")
    per_user = known.groupBy("device", as_user.alias("u")).agg(
        F.min("t_us").alias("created_us"), F.max("t_us").alias("last_seen_us"), F.min(at).alias("first_at"), F.count("*").alias("n")
    )
    is_user = F.col("u").isNotNull()
    return per_user.groupBy("device").agg(
        F.min("created_us").alias("created_us"), F.max("last_seen_us").alias("last_seen_us"),
        F.min_by("u", F.when(is_user, F.col("first_at"))).alias("owner"),
        (F.sum(F.when(is_user, F.col("n")).otherwise(0)) - F.coalesce(F.min_by(F.when(is_user, F.col("n")), F.when(is_user, F.col("first_at"))), F.lit(0))).alias("conflicts"),
    )


# Bounds of the lag histogram, in seconds.
LAG_BOUNDS_S = (0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 900.0, 3600.0, 14400.0, 86400.0)


def lag_bucket(seconds: Column) -> Column:
    """Index of the first bound at or above the lag; one more than the last when it exceeds all."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in LAG_BOUNDS_S]), lambda b: b < seconds))


def lag_histogram(lags: DataFrame, keys: list[str], seconds: Column) -> DataFrame:
    bound = F.get(F.array(*[F.lit(b) for b in LAG_BOUNDS_S]), F.col("bucket"))
    return lags.where(seconds.isNotNull()).groupBy(*keys, lag_bucket(seconds).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum(seconds).alias("total_s")
    ).withColumn("upper_s", bound)


def frames_by_status(frames: DataFrame, keys: list[str]) -> DataFrame:
    """How many frames have each status, per `keys`."""
    return frames.groupBy(*keys, "status").agg(F.count("*").alias("frames"))


def backlog(topics: DataFrame, offsets: DataFrame) -> DataFrame:
    """Messages a reader has not read yet; nothing for a reader whose position is unknown."""
    read = offsets.where(F.col("consumed_offset").isNotNull())
    return topics.join(read, "topic").select(
        "reader", "topic", F.greatest(F.lit(0), F.col("messages") - (F.col("consumed_offset") + 1)).alias("backlog")
    )


def first_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """De-duplicate by a natural key; the first in `order` wins."""
    others = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("r"))
    return best.select(*keys, "r.*")
