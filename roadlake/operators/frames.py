"""One-second device frames to samples: GPS, IMU and CAN explodes, receipts, checks, packet normalisation, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.text import blank_to_null
from roadlake.functions.units import GRAVITY, KPH_PER_CMS

# The frame layout, struct-of-arrays for GPS and IMU, array-of-structs for CAN.
_GPS = """STRUCT<count: INT, sample_period_us: LONG, dt_us: ARRAY<LONG>, lat_1e7: ARRAY<LONG>, lon_1e7: ARRAY<LONG>,
    alt_mm: ARRAY<INT>, speed_cms: ARRAY<INT>, heading_cdeg: ARRAY<INT>, fix_type: ARRAY<INT>, num_sats: ARRAY<INT>,
    hdop_x100: ARRAY<INT>, hacc_mm: ARRAY<INT>>"""
FRAME_SCHEMA = f"""version INT, device_id STRING, base_timestamp_us LONG, session_id LONG, lap_id LONG,
    imu STRUCT<count: INT, sample_period_us: LONG, quat_period_us: LONG, accel_x: ARRAY<INT>, accel_y: ARRAY<INT>,
        accel_z: ARRAY<INT>, gyro_x: ARRAY<INT>, gyro_y: ARRAY<INT>, gyro_z: ARRAY<INT>, quat_w: ARRAY<INT>,
        quat_x: ARRAY<INT>, quat_y: ARRAY<INT>, quat_z: ARRAY<INT>, missing: ARRAY<INT>>,
    gps {_GPS}, dongle_gps {_GPS}, can ARRAY<STRUCT<dt_us: LONG, can_id: LONG, data: BINARY>>"""

LIVE_SESSION = "proto-live"
AXES = ("x", "y", "z")


def _size(array: Column) -> Column:
    return F.coalesce(F.size(array), F.lit(0))


def gps_count(section: Column) -> Column:
    """Fixes a GPS section really holds."""
    return F.coalesce(
        F.greatest(F.lit(0), F.least(section["count"], _size(section["lat_1e7"]), _size(section["lon_1e7"]))), F.lit(0)
    )


def imu_count(section: Column) -> Column:
    arrays = [section[f"{kind}_{axis}"] for kind in ("accel", "gyro") for axis in AXES]
    return F.coalesce(F.greatest(F.lit(0), F.least(section["count"], *[_size(a) for a in arrays])), F.lit(0))


def session_text() -> Column:
    """The recording session as text; 0 or missing is live traffic outside any session."""
    live = F.coalesce(F.col("session_id"), F.lit(0)) == 0
    return F.when(live, LIVE_SESSION).otherwise(F.col("session_id").cast("string"))


def frame_reason() -> Column:
    """Why a frame is refused, null when it is not."""
    samples = gps_count(F.col("gps")) + gps_count(F.col("dongle_gps")) + imu_count(F.col("imu")) + _size(F.col("can"))
    return (
        F.when(blank_to_null(F.col("device_id")).isNull(), "device_id must be a non-empty string")
        .when(F.coalesce(F.col("base_timestamp_us"), F.lit(0)) <= 0, "base_timestamp_us must be present")
        .when(samples == 0, "no publishable samples")
    )


def split_frames(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid frames, diagnostics of the refused ones)."""
    judged = frames.withColumn("detail", frame_reason())
    diagnostics = judged.where("detail IS NOT NULL").select(
        "device_id", "base_timestamp_us", F.lit("INVALID_PAYLOAD").alias("reason"), "detail"
    )
    return judged.where("detail IS NULL").drop("detail"), diagnostics


def _at(array: Column, index: Column) -> Column:
    """Array element by zero-based index; null when the channel is absent or shorter."""
    return F.get(array, index)


def _envelope() -> list[Column]:
    return [F.col("device_id"), session_text().alias("source_session"), F.col("base_timestamp_us")]


def explode_gps(frames: DataFrame) -> DataFrame:
    """One row per fix, from the dongle's section when it has any, else the phone's. Only the index is exploded, so
    absent channels stay null; a fix's own offset is used only when every fix has one."""
    from_dongle = gps_count(F.col("dongle_gps")) > 0
    picked = frames.select(
        *_envelope(),
        F.when(from_dongle, "dongle").otherwise("phone").alias("gps_source"),
        F.when(from_dongle, F.col("dongle_gps")).otherwise(F.col("gps")).alias("g"),
    )
    rows = picked.where(gps_count(F.col("g")) > 0).select(
        "*", F.explode(F.sequence(F.lit(0), gps_count(F.col("g")) - 1)).alias("i")
    )
    g, i = F.col("g"), F.col("i")
    offset = F.when(_size(g["dt_us"]) == g["count"], _at(g["dt_us"], i)).otherwise(i * g["sample_period_us"])
    return rows.select(
        "device_id", "source_session", "base_timestamp_us", "gps_source", i.alias("sample_no"),
        (F.col("base_timestamp_us") + offset).alias("t_us"),
        (_at(g["lat_1e7"], i) / F.lit(1e7)).alias("latitude"),
        (_at(g["lon_1e7"], i) / F.lit(1e7)).alias("longitude"),
        (_at(g["alt_mm"], i) / F.lit(1000.0)).alias("altitude_m"),
        (_at(g["speed_cms"], i) * F.lit(KPH_PER_CMS)).alias("ground_speed_kph"),
        (_at(g["heading_cdeg"], i) / F.lit(100.0)).alias("heading_deg"),
        _at(g["fix_type"], i).alias("fix_type"),
        _at(g["num_sats"], i).alias("num_sats"),
        (_at(g["hdop_x100"], i) / F.lit(100.0)).alias("hdop"),
        (_at(g["hacc_mm"], i) / F.lit(1000.0)).alias("hacc_m"),
    )


def explode_imu(frames: DataFrame) -> DataFrame:
    """One row per IMU sample, with the quaternion on the samples that fall on its own, slower grid."""
    rows = frames.where(imu_count(F.col("imu")) > 0).select(
        *_envelope(), F.col("imu").alias("m"), F.explode(F.sequence(F.lit(0), imu_count(F.col("imu")) - 1)).alias("i")
    )
    m, i = F.col("m"), F.col("i")
    elapsed, period = i * m["sample_period_us"], m["quat_period_us"]
    slot = F.when((period > 0) & (elapsed % F.nullif(period, F.lit(0)) == 0), F.floor(elapsed / F.nullif(period, F.lit(0))).cast("int"))
    quats = F.least(*[_size(m[f"quat_{part}"]) for part in "wxyz"])
    quaternion = F.when(
        slot < quats, F.struct(*[(_at(m[f"quat_{part}"], slot) / F.lit(32767.0)).alias(part) for part in "wxyz"])
    )
    accel = F.struct(*[(_at(m[f"accel_{a}"], i) / F.lit(1000.0) * F.lit(GRAVITY)).alias(a) for a in AXES])
    gyro = F.struct(*[(_at(m[f"gyro_{a}"], i) / F.lit(100.0)).alias(a) for a in AXES])
    return rows.select(
        "device_id", "source_session", "base_timestamp_us", i.alias("sample_no"),
        (F.col("base_timestamp_us") + elapsed).alias("t_us"),
        accel.alias("accel_m_s2"), gyro.alias("gyro_deg_s"), quaternion.alias("quaternion"),
    )


def explode_can(frames: DataFrame) -> DataFrame:
    """One row per CAN message, at the frame's base time plus its own offset."""
    rows = frames.select(*_envelope(), F.posexplode("can").alias("sample_no", "c"))
    return rows.select(
        "device_id", "source_session", "base_timestamp_us", "sample_no",
        (F.col("base_timestamp_us") + F.col("c.dt_us")).alias("t_us"),
        F.col("c.can_id").alias("can_id"),
        F.lower(F.hex("c.data")).alias("data_hex"),
        F.length("c.data").alias("dlc"),
        F.col("c.dt_us").alias("dt_us"),
    )


def receipts(frames: DataFrame) -> DataFrame:
    """One row per frame of a recording session, with the sample counts it was sent with."""
    dongle = gps_count(F.col("dongle_gps"))
    count = F.when(dongle > 0, dongle).otherwise(gps_count(F.col("gps")))
    return frames.where(F.coalesce(F.col("session_id"), F.lit(0)) != 0).select(
        *_envelope(),
        count.alias("gps"),
        F.when(count > 0, F.when(dongle > 0, "dongle").otherwise("phone")).alias("gps_source"),
        imu_count(F.col("imu")).alias("imu"),
        _size(F.col("imu.missing")).alias("imu_missing"),
        _size(F.col("can")).alias("can"),
    )


# Words in a source's name, in the order they are tried, and the topic of each type.
SOURCE_WORDS = (
    ("session", ("session",)),
    ("imu", ("imu", "mpu")),
    ("rtk", ("rtk", "ntrip", "base")),
    ("can", ("can",)),
    ("gps", ("gps", "gnss")),
)
TOPIC_PREFIX = "telemetry.raw."
SESSION_TOPIC = "telemetry.session"


def source_type(source: Column) -> Column:
    """The type a source's name implies; GPS when none does."""
    lowered, out = F.lower(source), None
    for kind, words in SOURCE_WORDS:
        hit = lowered.rlike("|".join(words))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("gps")


def topic_of(kind: Column) -> Column:
    return F.when(kind == "session", SESSION_TOPIC).otherwise(F.concat(F.lit(TOPIC_PREFIX), kind))


def account_of(topic: Column, base: str) -> Column:
    """The account: the single level below the base topic, never anything in the payload."""
    return F.nullif(F.regexp_extract(topic, f"^{base}/([^/]+)$", 1), F.lit(""))


def _required(payload: Column, name: str) -> Column:
    return blank_to_null(F.get_json_object(payload, f"$.{name}"))


def normalise_json(packets: DataFrame, base_topic: str = "telemetry") -> DataFrame:
    """JSON packets (`mqtt_topic`, `payload`) to the sample envelope; `reason` is set on refused ones."""
    p = F.col("payload")
    source, device, session = (_required(p, n) for n in ("source", "device_id", "source_session"))
    kind = source_type(source)
    reason = (
        F.when(F.try_parse_json(p).isNull() | ~F.trim(p).startswith("{"), "payload is not a JSON object")
        .when(source.isNull(), "source must be a non-empty string")
        .when(device.isNull(), "device_id must be a non-empty string")
        .when(session.isNull(), "source_session must be a non-empty string")
    )
    return packets.select(
        *packets.columns,
        reason.alias("reason"), kind.alias("source_type"), topic_of(kind).alias("topic"), device.alias("device_id"),
        source.alias("source"), session.alias("source_session"),
        F.coalesce(F.get_json_object(p, "$.message_type"), F.lit("telemetry")).alias("message_type"),
        F.get_json_object(p, "$.captured_at").alias("captured_at"),
        F.concat(session, F.lit(":"), device).alias("session_id"),
        account_of(F.col("mqtt_topic"), base_topic).alias("user_sub"),
    )


def normalise_compact(packets: DataFrame, base_topic: str = "telemetry") -> DataFrame:
    """Compact packets (`did`, `sid`, `tp` columns). Their clock counts from boot, so there is no capture time."""
    kind = F.when(F.col("tp").isin("imu", "gps", "can"), F.col("tp"))
    session = F.nullif(F.col("sid").cast("string"), F.lit(""))
    reason = (
        F.when(blank_to_null(F.col("did")).isNull(), "did must be a non-empty string")
        .when(session.isNull(), "sid must be present and non-empty")
        .when(kind.isNull(), "unknown tp value")
    )
    return packets.select(
        *packets.columns,
        reason.alias("reason"), kind.alias("source_type"), topic_of(kind).alias("topic"), F.col("did").alias("device_id"),
        F.col("tp").alias("source"), session.alias("source_session"), F.lit("telemetry").alias("message_type"),
        F.lit(None).cast("string").alias("captured_at"), F.concat(session, F.lit(":"), F.col("did")).alias("session_id"),
        account_of(F.col("mqtt_topic"), base_topic).alias("user_sub"),
    )
