"""Queries over device frames, packets and CAN decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.operators import decode, frames
from roadlake.plans.registry import q4, query, s4
from roadlake.plans.views import events, table, v_can, v_signal
from roadlake.sources import envelope
from roadlake.sources.dbc import parse_dbc


# ---- one-second frames, one per order, built row by row ----

def order_frames(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    ten = F.sequence(F.lit(0), F.lit(9))

    def channel(n, make):
        return F.transform(F.slice(ten, 1, n), lambda i: make(i).cast("long"))

    def ints(n, make):
        return channel(n, make).cast("array<int>")

    none = F.array().cast("array<int>")
    n = (k % 4).cast("int")
    d = F.when(k % 7 == 0, 2).otherwise(0)
    lats = F.when(k % 14 == 0, 1).otherwise(d)

    def gps(count, size, shift):
        return F.struct(
            count.alias("count"), F.lit(500_000).cast("long").alias("sample_period_us"),
            F.when(k % 3 == 0, channel(count, lambda i: i * 333_000)).otherwise(none.cast("array<long>")).alias("dt_us"),
            channel(size, lambda i: 400_000_000 + (k * 37 + i * 11 + shift) % 10_000).alias("lat_1e7"),
            channel(size, lambda i: -1_110_000_000 + (k * 91 + i * 17 + shift) % 10_000).alias("lon_1e7"),
            F.when(k % 2 == 0, ints(size, lambda i: (k + i) % 5000)).otherwise(none).alias("alt_mm"),
            ints(size, lambda i: (k * 7 + i * 13) % 3000).alias("speed_cms"),
            ints(size, lambda i: (k * 3 + i) % 36000).alias("heading_cdeg"),
            F.array(F.lit(3)).alias("fix_type"), none.alias("num_sats"), none.alias("hdop_x100"),
            ints(size, lambda i: (k + i) % 9000).alias("hacc_mm"),
        )

    m = F.when(k % 5 == 0, 0).otherwise(5)
    short = F.when(k % 11 == 0, F.least(m, F.lit(4))).otherwise(m)
    imu = F.struct(
        m.alias("count"), F.lit(20_000).cast("long").alias("sample_period_us"), F.lit(40_000).cast("long").alias("quat_period_us"),
        *[ints(m, lambda i, s=s: (k + i * 3) % (700 + s) - 300).alias(f"accel_{a}") for s, a in enumerate("xyz")],
        *[ints(short if a == "z" else m, lambda i, s=s: (k * 5 + i) % (900 + s)).alias(f"gyro_{a}") for s, a in enumerate("xyz")],
        *[ints(F.lit(2), lambda i, s=s: (k + i + s) % 32768).alias(f"quat_{p}") for s, p in enumerate("wxyz")],
        ints((k % 3).cast("int"), lambda i: i).alias("missing"),
    )
    can = F.transform(
        F.slice(ten, 1, n),
        lambda i: F.struct(
            (i * 20_000).cast("long").alias("dt_us"), (i + 512).cast("long").alias("can_id"),
            F.unhex(F.lpad(F.hex(k * 31 + i), 8, "0")).alias("data"),
        ),
    )
    return table(spark, sf, "orders").select(
        k.alias("frame_no"), F.lit(1).alias("version"),
        F.when(k % 50 == 0, " ").otherwise(F.concat(F.lit("d"), k % 10)).alias("device_id"),
        F.when(k % 60 == 0, 0).otherwise(k * 1_000_000).alias("base_timestamp_us"),
        (k % 97).alias("session_id"), F.lit(0).cast("long").alias("lap_id"),
        imu.alias("imu"), gps(n, n, 0).alias("gps"), gps(d, lats, 5000).alias("dongle_gps"), can.alias("can"),
    )


_FRAMES_SQL = """
  fr AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey%50=0 THEN ' ' ELSE 'd'||(o_orderkey%10) END AS device_id,
      CASE WHEN o_orderkey%60=0 THEN 0 ELSE o_orderkey*1000000 END AS base_timestamp_us,
      CASE WHEN o_orderkey%97=0 THEN 'proto-live' ELSE CAST(o_orderkey%97 AS VARCHAR) END AS source_session,
      o_orderkey%4 AS n, CASE WHEN o_orderkey%14=0 THEN 1 WHEN o_orderkey%7=0 THEN 2 ELSE 0 END AS d,
      CASE WHEN o_orderkey%7=0 THEN 2 ELSE 0 END AS dc,
      CASE WHEN o_orderkey%5=0 THEN 0 WHEN o_orderkey%11=0 THEN 4 ELSE 5 END AS m FROM orders),
  judged AS (SELECT *, CASE WHEN trim(device_id)='' THEN 'device_id must be a non-empty string'
      WHEN base_timestamp_us<=0 THEN 'base_timestamp_us must be present' WHEN n+d+m=0 THEN 'no publishable samples' END AS detail FROM fr),
  good AS (SELECT * FROM judged WHERE detail IS NULL)"""


def _valid(spark, sf):
    return frames.split_frames(order_frames(spark, sf))[0]


@query(
    "s3_gps_explode",
    f"""WITH {_FRAMES_SQL}, g AS (SELECT *, CASE WHEN d>0 THEN d ELSE n END AS c, CASE WHEN d>0 THEN 5000 ELSE 0 END AS shift,
      CASE WHEN d>0 THEN d ELSE n END AS size FROM good), x AS (SELECT * FROM g, range(10) r(i) WHERE i < c)
    SELECT device_id, source_session, CASE WHEN d>0 THEN 'dongle' ELSE 'phone' END AS gps_source, i AS sample_no,
      base_timestamp_us + CASE WHEN k%3=0 THEN i*333000 ELSE i*500000 END AS t_us,
      {s4('(400000000 + (k*37+i*11+shift)%10000)/1e7')} AS latitude, {s4('(-1110000000 + (k*91+i*17+shift)%10000)/1e7')} AS longitude,
      CASE WHEN k%2=0 THEN {s4('((k+i)%5000)/1000.0e0')} END AS altitude_m, {s4('((k*7+i*13)%3000)*0.036e0')} AS ground_speed_kph,
      {s4('((k*3+i)%36000)/100.0e0')} AS heading_deg, CAST(CASE WHEN i=0 THEN 3 END AS BIGINT) AS fix_type, {s4('((k+i)%9000)/1000.0e0')} AS hacc_m FROM x""",
)
def s3(spark, sf):
    rows = frames.explode_gps(_valid(spark, sf))
    return rows.select(
        "device_id", "source_session", "gps_source", F.col("sample_no").cast("long").alias("sample_no"), "t_us",
        *[q4(F.col(c)).alias(c) for c in ("latitude", "longitude", "altitude_m", "ground_speed_kph", "heading_deg", "hacc_m")],
        F.col("fix_type").cast("long").alias("fix_type"),
    )


@query(
    "s4_imu_explode",
    f"""WITH {_FRAMES_SQL}, x AS (SELECT * FROM good, range(10) r(i) WHERE i < m)
    SELECT source_session, t_us, sample_no, ax, gz, qw, count(*) AS copies FROM (
      SELECT source_session, base_timestamp_us + i*20000 AS t_us, i AS sample_no, {s4('((k+i*3)%700-300)/1000.0e0*9.80665e0')} AS ax,
      {s4('((k*5+i)%902)/100.0e0')} AS gz, CASE WHEN i*20000%40000=0 AND i*20000//40000 < 2 THEN {s4('((k+i*20000//40000)%32768)/32767.0e0')} END AS qw FROM x) GROUP BY ALL""",
)
def s4_imu(spark, sf):
    rows = frames.explode_imu(_valid(spark, sf)).select(
        "source_session", "t_us", F.col("sample_no").cast("long").alias("sample_no"), q4(F.col("accel_m_s2.x")).alias("ax"),
        q4(F.col("gyro_deg_s.z")).alias("gz"), q4(F.col("quaternion.w")).alias("qw"),
    )
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))


@query(
    "s5_can_explode",
    f"""WITH {_FRAMES_SQL}, x AS (SELECT * FROM good, range(10) r(i) WHERE i < n)
    SELECT source_session, base_timestamp_us + i*20000 AS t_us, i*20000 AS dt_us, i+512 AS can_id, printf('%08x', k*31+i) AS data_hex,
    CAST(4 AS INTEGER) AS dlc FROM x""",
)
def s5(spark, sf):
    return frames.explode_can(_valid(spark, sf)).select("source_session", "t_us", "dt_us", "can_id", "data_hex", "dlc")


@query(
    "s5_frame_receipt",
    f"""WITH {_FRAMES_SQL} SELECT device_id, source_session, base_timestamp_us, CAST(CASE WHEN d>0 THEN d ELSE n END AS INTEGER) AS gps,
    CASE WHEN d>0 THEN 'dongle' WHEN n>0 THEN 'phone' END AS gps_source, CAST(m AS INTEGER) AS imu, CAST(k%3 AS INTEGER) AS imu_missing,
    CAST(n AS INTEGER) AS can FROM good WHERE source_session <> 'proto-live'""",
)
def s5_receipt(spark, sf):
    return frames.receipts(_valid(spark, sf))


@query(
    "s6_frame_diagnostics",
    f"WITH {_FRAMES_SQL} SELECT device_id, 'INVALID_PAYLOAD' AS reason, detail, count(*) AS n FROM judged WHERE detail IS NOT NULL GROUP BY ALL",
)
def s6(spark, sf):
    refused = frames.split_frames(order_frames(spark, sf))[1]
    return refused.groupBy("device_id", "reason", "detail").agg(F.count("*").alias("n"))


_SOURCE_SQL = """CASE event_id%9 WHEN 0 THEN 'Phone-SESSION-can' WHEN 1 THEN 'MPU6050' WHEN 2 THEN 'ntrip-can' WHEN 3 THEN 'CANbus'
    WHEN 4 THEN 'u-blox GNSS' WHEN 5 THEN 'baseline' WHEN 6 THEN 'imu-gps' ELSE event_type END"""
_TYPE_SQL = """CASE WHEN lower(source) LIKE '%session%' THEN 'session' WHEN lower(source) LIKE '%imu%' OR lower(source) LIKE '%mpu%' THEN 'imu'
    WHEN lower(source) LIKE '%rtk%' OR lower(source) LIKE '%ntrip%' OR lower(source) LIKE '%base%' THEN 'rtk' WHEN lower(source) LIKE '%can%' THEN 'can' ELSE 'gps' END"""


def _source():
    names = ["Phone-SESSION-can", "MPU6050", "ntrip-can", "CANbus", "u-blox GNSS", "baseline", "imu-gps"]
    out = F.col("event_type")
    for i, name in enumerate(names):
        out = F.when(F.col("event_id") % 9 == i, name).otherwise(out)
    return out


@query(
    "s7_topic_routing",
    f"""WITH s AS (SELECT {_SOURCE_SQL} AS source FROM events), t AS (SELECT source, {_TYPE_SQL} AS source_type FROM s)
    SELECT source, source_type, CASE WHEN source_type='session' THEN 'telemetry.session' ELSE 'telemetry.raw.'||source_type END AS topic, count(*) AS n FROM t GROUP BY ALL""",
)
def s7(spark, sf):
    kind = frames.source_type(F.col("source"))
    rows = table(spark, sf, "events").select(_source().alias("source"))
    return rows.groupBy("source", kind.alias("source_type"), frames.topic_of(kind).alias("topic")).agg(F.count("*").alias("n"))


@query(
    "s8_packet_json",
    f"""WITH p AS (SELECT event_id, {_SOURCE_SQL} AS source, user_id, value,
      CASE WHEN event_id%3=0 THEN 'telemetry' ELSE 'telemetry/acct-'||(user_id%5) END AS mqtt_topic FROM events),
    n AS (SELECT *, {_TYPE_SQL} AS source_type, CASE WHEN event_id%23=0 THEN 'payload is not a JSON object' WHEN event_id%19=0 THEN 'device_id must be a non-empty string' END AS reason FROM p)
    SELECT event_id, reason, CASE WHEN event_id%23<>0 THEN source_type END AS source_type,
      CASE WHEN event_id%23<>0 THEN CASE WHEN source_type='session' THEN 'telemetry.session' ELSE 'telemetry.raw.'||source_type END END AS topic,
      CASE WHEN event_id%23<>0 AND event_id%19<>0 THEN 'd'||user_id END AS device_id,
      CASE WHEN event_id%23<>0 AND event_id%19<>0 THEN 'u'||user_id||':d'||user_id END AS session_id,
      CASE WHEN event_id%23<>0 AND event_id%4=0 THEN 'lap_anchor' ELSE 'telemetry' END AS message_type,
      CASE WHEN event_id%3<>0 THEN 'acct-'||(user_id%5) END AS user_sub FROM n""",
)
def s8(spark, sf):
    e = F.col("event_id")
    device = F.when(e % 19 == 0, F.lit(" ")).otherwise(F.concat(F.lit("d"), "user_id"))
    body = F.to_json(F.struct(
        _source().alias("source"), device.alias("device_id"), F.concat(F.lit("u"), "user_id").alias("source_session"),
        F.when(e % 4 == 0, "lap_anchor").alias("message_type"), "value", F.lit("owner-in-payload").alias("user_sub"),
    ))
    packets = table(spark, sf, "events").select(
        "event_id",
        F.when(e % 3 == 0, "telemetry").otherwise(F.concat(F.lit("telemetry/acct-"), F.col("user_id") % 5)).alias("mqtt_topic"),
        F.when(e % 23 == 0, F.lit("[1, 2")).otherwise(body).alias("payload"),
    )
    out = frames.normalise_json(packets)
    whole = F.col("reason").isNull() | ~F.col("reason").startswith("payload")
    return out.select(
        "event_id", "reason", *[F.when(whole, F.col(c)).alias(c) for c in ("source_type", "topic", "device_id", "session_id")],
        "message_type", "user_sub",
    )


@query(
    "s8_packet_compact",
    """WITH p AS (SELECT *, CASE event_id%5 WHEN 0 THEN 'imu' WHEN 1 THEN 'gps' WHEN 2 THEN 'can' WHEN 3 THEN 'lidar' END AS tp,
      CASE WHEN event_id%13<>0 THEN user_id END AS sid FROM events)
    SELECT event_id, CASE WHEN sid IS NULL THEN 'sid must be present and non-empty' WHEN tp IS NULL OR tp='lidar' THEN 'unknown tp value' END AS reason,
    CASE WHEN tp<>'lidar' THEN tp END AS source_type, CASE WHEN tp<>'lidar' THEN 'telemetry.raw.'||tp END AS topic,
    CASE WHEN sid IS NOT NULL THEN sid||':c'||user_id END AS session_id, CAST(NULL AS VARCHAR) AS captured_at FROM p""",
)
def s8c(spark, sf):
    e = F.col("event_id")
    tp = F.when(e % 5 == 0, "imu").when(e % 5 == 1, "gps").when(e % 5 == 2, "can").when(e % 5 == 3, "lidar")
    packets = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("c"), "user_id").alias("did"), F.when(e % 13 != 0, F.col("user_id")).alias("sid"),
        tp.alias("tp"), F.lit("telemetry").alias("mqtt_topic"),
    )
    return frames.normalise_compact(packets).select("event_id", "reason", "source_type", "topic", "session_id", "captured_at")


@query(
    "s1_envelope_unwrap",
    f"""SELECT event_id, CASE WHEN event_id%4=3 THEN NULL ELSE 'd'||user_id END AS device_id, CASE WHEN event_id%4 IN (1,2) THEN 'u'||user_id END AS header_session,
    {s4('value')} AS reading FROM events""",
)
def s1(spark, sf):
    e = F.col("event_id")
    flat = F.to_json(F.struct(F.concat(F.lit("d"), "user_id").alias("device_id"), F.struct(F.struct("value").alias("b")).alias("a")))
    bare = F.to_json(F.struct(F.struct(F.struct("value").alias("b")).alias("a")))
    head = F.to_json(F.struct(F.concat(F.lit("u"), "user_id").alias("x-session-id")))
    wrapped = F.concat(F.lit('{"body":'), flat, F.lit(',"headers":'), head, F.lit("}"))
    packed = F.concat(F.lit('{"payload_b64":"'), F.base64(F.encode(flat, "UTF-8")), F.lit('","headers":'), head, F.lit("}"))
    value = F.when(e % 4 == 0, flat).when(e % 4 == 1, wrapped).when(e % 4 == 2, packed).otherwise(bare)
    out = envelope.unwrap(table(spark, sf, "events").select("event_id", value.alias("value")))
    return out.select(
        "event_id", F.get_json_object("record", "$.device_id").alias("device_id"),
        F.get_json_object("headers", "$.x-session-id").alias("header_session"), q4(envelope.number(F.col("record"), "a.b.value")).alias("reading"),
    )


@query(
    "s2_required_fields",
    """WITH r AS (SELECT event_id, CASE WHEN event_id%11=0 THEN '  ' ELSE device END AS device, session, CASE WHEN event_id%7<>0 THEN value END AS speed,
      CASE WHEN event_id%5=0 THEN NULL WHEN event_id%5=1 THEN t_us - t_us%1000000 ELSE t_us - t_us%1000000 END AS t0, event_id%5 AS c FROM v_signal),
    t AS (SELECT *, CASE WHEN c = 0 AND event_id%3=0 THEN NULL WHEN c = 0 THEN (SELECT 1000000) ELSE t0 END AS t_us FROM r)
    SELECT coalesce(CASE WHEN trim(device)='' THEN 'device' WHEN speed IS NULL THEN 'speed' WHEN t_us IS NULL THEN 't_us' END, 'ok') AS verdict,
    count(*) AS n, CAST(sum(t_us // 1000000) AS BIGINT) AS seconds FROM t GROUP BY 1""",
    ("v_signal",),
)
def s2(spark, sf):
    e = F.col("event_id")
    iso = F.date_format(F.timestamp_micros(F.col("t_us") - F.pmod("t_us", F.lit(1_000_000))), "yyyy-MM-dd'T'HH:mm:ss")
    captured = F.when(e % 5 == 0, F.lit(" ")).when(e % 5 == 1, F.concat(iso, F.lit("Z"))).otherwise(F.concat(iso, F.lit("+00:00")))
    received = F.when(e % 3 == 0, F.lit("yesterday")).otherwise(F.lit("1970-01-01T00:00:01Z"))
    rows = v_signal(spark, sf).select(
        F.when(e % 11 == 0, F.lit("  ")).otherwise(F.col("device")).alias("device"), "session",
        F.when(e % 7 != 0, F.col("value")).alias("speed"), envelope.event_time_us(captured, received).alias("t_us"),
    )
    judged = envelope.required(rows, envelope.SPEED_FIELDS)
    return judged.groupBy(F.coalesce("missing", F.lit("ok")).alias("verdict")).agg(
        F.count("*").alias("n"), F.sum(F.floor(F.col("t_us") / 1_000_000)).cast("long").alias("seconds")
    )


@query(
    "s10_dbc_parse",
    """SELECT 'f'||(p_partkey%20) AS dbc, (p_partkey - p_partkey//20%4*20)%536870912 AS can_id, 'Msg'||(p_partkey - p_partkey//20%4*20) AS message, CAST(8 AS INTEGER) AS dlc,
    'Sig'||p_partkey AS signal, CASE WHEN p_partkey%9=0 THEN 'm'||(p_partkey%3) END AS mux, CAST(p_size%32 AS INTEGER) AS start, CAST(p_partkey%16+1 AS INTEGER) AS length,
    p_partkey%2=1 AS little_endian, p_partkey%3=0 AS signed, p_retailprice/8.0e0 AS scale, CAST(-p_size AS DOUBLE) AS "offset", p_brand AS unit
    FROM part WHERE (p_partkey - p_partkey//20%4*20) IN (SELECT p_partkey FROM part)""",
)
def s10(spark, sf):
    k = F.col("p_partkey")
    head = F.floor(k / 20) % 4 == 0
    # flagged as an extended id on every third message
    bo = F.concat(F.lit("BO_ "), F.when(k % 3 == 0, k + 2_147_483_648).otherwise(k).cast("string"), F.lit(" Msg"), k, F.lit(": 8 ECU"))
    sg = F.concat(
        F.lit(" SG_ Sig"), k, F.when(k % 9 == 0, F.concat(F.lit(" m"), k % 3)).otherwise(""), F.lit(" : "), F.col("p_size") % 32, F.lit("|"), k % 16 + 1,
        F.when(k % 2 == 1, "@1").otherwise("@0"), F.when(k % 3 == 0, "-").otherwise("+"),
        F.lit(" ("), (F.col("p_retailprice") / 8.0).cast("string"), F.lit(","), (-F.col("p_size")).cast("string"), F.lit(') [0|1] "'), F.col("p_brand"), F.lit('" X'),
    )
    part = table(spark, sf, "part").withColumn("dbc", F.concat(F.lit("f"), k % 20))
    lines = part.where(head).select("dbc", (k * 2).alias("line_no"), bo.alias("line")).unionByName(
        part.select("dbc", (k * 2 + 1).alias("line_no"), sg.alias("line"))
    )
    return parse_dbc(lines).drop("line_no")


# ---- decoding ----

# (dbc, can_id, message, dlc, signal, start, length, little_endian, signed, scale, offset, unit)
DBC_ROWS = [
    ("default", 513, "D1", 2, "LowByte", 8, 8, True, False, 1.0, 0.0, ""),
    ("alpha", 513, "M1", 8, "Part", 7, 16, False, False, 1.0, 0.0, "n"),
    ("alpha", 513, "M1", 8, "PartSwapped", 0, 16, True, False, 0.5, -10.0, "n"),
    ("alpha", 514, "M2", 8, "Supp12", 19, 12, False, True, 2.0, 1.0, "n"),
    ("alpha", 515, "M3", 6, "Quantity", 39, 16, False, False, 0.01, 0.0, "kg"),
    ("alpha", 516, "M4", 8, "QuantitySwapped", 32, 16, True, True, 1.0, 0.0, ""),
    ("alpha", 517, "M5", 8, "TooFar", 60, 8, True, False, 1.0, 0.0, ""),
    ("alpha", 518, "M6", 3, "Supp5", 20, 5, False, True, 1.0, 0.0, ""),
    ("beta", 513, "B1", 2, "PartHigh", 7, 8, False, True, 0.25, 3.0, ""),
    ("beta", 519, "B2", 8, "Whole", 7, 64, False, False, 1.0, 0.0, ""),
]
_DBC_SCHEMA = ("dbc string, can_id long, message string, dlc int, signal string, start int, length int, little_endian boolean, "
               "signed boolean, scale double, offset double, unit string")


def dimensions(spark: SparkSession, sf: str):
    """Sessions from the orders; vehicles and DBCs are the few the sessions point at."""
    k = F.col("o_orderkey")
    sessions = (
        table(spark, sf, "orders").where((k % 97 % 9 != 0))
        .select(F.concat(F.lit("s"), k % 97).alias("session"), F.concat(F.lit("d"), k % 10).alias("device"),
                F.when(k % 97 % 5 != 0, k % 97 % 7).alias("vehicle_id"))
        .distinct()
    )
    vehicles = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (3, 1), (4, None), (5, 2)], "vehicle_id long, dbc_id long")
    dbcs = spark.createDataFrame([(1, "alpha", True), (2, "beta", True), (3, "gamma", False)], "dbc_id long, name string, parses boolean")
    return sessions, vehicles, dbcs


def raw_frames(spark: SparkSession, sf: str) -> DataFrame:
    return v_can(spark, sf).select(
        F.when(F.col("session") == "s9", "proto-live").otherwise(F.col("session")).alias("session"), "device", "t_us", "seq", "can_id",
        F.when(F.col("seq") % 29 == 0, "zz").when(F.col("seq") % 6 == 0, F.substring("data_hex", 1, 6)).otherwise(F.col("data_hex")).alias("data_hex"),
    )


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    return decode.resolve_dbc(raw_frames(spark, sf), *dimensions(spark, sf))


_RESOLVED_SQL = """
  raw AS (SELECT CASE WHEN session='s9' THEN 'proto-live' ELSE session END AS session, device, t_us, seq, can_id,
      CASE WHEN seq%29=0 THEN 'zz' WHEN seq%6=0 THEN substr(data_hex,1,6) ELSE data_hex END AS data_hex,
      CAST(substr(session,2) AS BIGINT) AS sn FROM v_can),
  known AS (SELECT DISTINCT 's'||(o_orderkey%97) AS session, 'd'||(o_orderkey%10) AS device FROM orders WHERE o_orderkey%97%9<>0),
  res AS (SELECT r.*, CASE WHEN r.session='proto-live' THEN NULL WHEN k.session IS NULL THEN 'session not found' WHEN sn%5=0 THEN 'session has no vehicle'
        WHEN sn%7 IN (4,6) THEN 'vehicle has no DBC' WHEN sn%7=2 THEN 'DBC ''gamma'' does not parse' END AS no_dbc
      FROM raw r LEFT JOIN known k ON k.session=r.session AND k.device=r.device),
  res2 AS (SELECT *, CASE WHEN session='proto-live' THEN 'default' WHEN no_dbc IS NULL THEN CASE WHEN sn%7 IN (0,3) THEN 'alpha' ELSE 'beta' END END AS dbc,
      length(data_hex)//2 AS nb FROM res),
  outc AS (SELECT *, CASE WHEN dbc='default' AND can_id=513 THEN 2 WHEN dbc='alpha' THEN CASE can_id WHEN 513 THEN 8 WHEN 514 THEN 8 WHEN 515 THEN 6 WHEN 516 THEN 8 WHEN 517 THEN 9 WHEN 518 THEN 3 END
      WHEN dbc='beta' THEN CASE can_id WHEN 513 THEN 2 WHEN 519 THEN 8 END END AS need FROM res2)"""


@query(
    "c2_dbc_resolution",
    f"WITH {_RESOLVED_SQL} SELECT session, device, dbc, no_dbc, count(*) AS n FROM res2 GROUP BY ALL",
    ("v_can",),
)
def c2(spark, sf):
    return resolved(spark, sf).groupBy("session", "device", "dbc", "no_dbc").agg(F.count("*").alias("n"))


@query(
    "c3_outcome_split",
    f"""WITH {_RESOLVED_SQL} SELECT session, CASE WHEN data_hex='zz' THEN 'unreadable' WHEN no_dbc='session not found' THEN 'dropped' WHEN no_dbc IS NOT NULL THEN 'discovery'
      WHEN need IS NULL OR nb<need THEN 'unknown' ELSE 'decoded' END AS outcome,
      CASE WHEN data_hex='zz' THEN NULL WHEN no_dbc IS NOT NULL THEN no_dbc WHEN need IS NULL THEN 'no_dbc_message' WHEN nb<need THEN 'layout_mismatch' END AS reason,
      count(*) AS n FROM outc GROUP BY ALL""",
    ("v_can",),
)
def c3(spark, sf):
    signals = spark.createDataFrame(DBC_ROWS, _DBC_SCHEMA)
    return decode.classify(resolved(spark, sf), signals).groupBy("session", "outcome", "reason").agg(F.count("*").alias("n"))


_DECODE_SQL = _RESOLVED_SQL + """,
  fit AS (SELECT *, CAST('0x'||substr(data_hex,1,2) AS BIGINT) AS b0, CAST('0x'||substr(data_hex,3,2) AS BIGINT) AS b1, CAST('0x'||coalesce(nullif(substr(data_hex,5,2),''),'0') AS BIGINT) AS b2,
      CAST('0x'||coalesce(nullif(substr(data_hex,7,2),''),'0') AS BIGINT) AS b3, CAST('0x'||coalesce(nullif(substr(data_hex,9,2),''),'0') AS BIGINT) AS b4,
      CAST('0x'||coalesce(nullif(substr(data_hex,11,2),''),'0') AS BIGINT) AS b5
      FROM outc WHERE data_hex<>'zz' AND need IS NOT NULL AND nb>=need),
  dec AS (
      SELECT session, dbc, can_id, 'LowByte' AS signal, CAST(b1 AS DOUBLE) AS value FROM fit WHERE dbc='default' AND can_id=513
      UNION ALL SELECT session, dbc, can_id, 'Part', CAST(b0*256+b1 AS DOUBLE) FROM fit WHERE dbc='alpha' AND can_id=513
      UNION ALL SELECT session, dbc, can_id, 'PartSwapped', (b1*256+b0)*0.5e0-10 FROM fit WHERE dbc='alpha' AND can_id=513
      UNION ALL SELECT session, dbc, can_id, 'Supp12', CAST((CASE WHEN ((b2*256+b3)&4095)>=2048 THEN ((b2*256+b3)&4095)-4096 ELSE (b2*256+b3)&4095 END)*2+1 AS DOUBLE) FROM fit WHERE dbc='alpha' AND can_id=514
      UNION ALL SELECT session, dbc, can_id, 'Quantity', (b4*256+b5)*0.01e0 FROM fit WHERE dbc='alpha' AND can_id=515
      UNION ALL SELECT session, dbc, can_id, 'QuantitySwapped', CAST(CASE WHEN b5>=128 THEN b5*256+b4-65536 ELSE b5*256+b4 END AS DOUBLE) FROM fit WHERE dbc='alpha' AND can_id=516
      UNION ALL SELECT session, dbc, can_id, 'Supp5', CAST(CASE WHEN (b2&31)>=16 THEN (b2&31)-32 ELSE b2&31 END AS DOUBLE) FROM fit WHERE dbc='alpha' AND can_id=518
      UNION ALL SELECT session, dbc, can_id, 'PartHigh', (CASE WHEN b0>=128 THEN b0-256 ELSE b0 END)*0.25e0+3 FROM fit WHERE dbc='beta' AND can_id=513
      UNION ALL SELECT session, dbc, can_id, 'Whole', CAST(CAST('0x'||data_hex AS UBIGINT) AS DOUBLE) FROM fit WHERE dbc='beta' AND can_id=519)"""


@query(
    "c1_dbc_decode",
    f"""WITH {_DECODE_SQL} SELECT session, dbc, can_id, signal, count(*) AS n, {s4("sum(CASE WHEN signal='Whole' THEN value/1e15 ELSE value END)")} AS total,
    {s4("min(CASE WHEN signal='Whole' THEN value/1e15 ELSE value END)")} AS low, {s4("max(CASE WHEN signal='Whole' THEN value/1e15 ELSE value END)")} AS high FROM dec GROUP BY ALL""",
    ("v_can",),
)
def c1(spark, sf):
    signals = spark.createDataFrame(DBC_ROWS, _DBC_SCHEMA)
    frames_in = resolved(spark, sf).where("data_hex <> 'zz'")
    value = F.when(F.col("signal") == "Whole", F.col("value") / 1e15).otherwise(F.col("value"))
    rows = decode.decode(frames_in, signals).withColumn("value", value)
    return rows.groupBy("session", "dbc", "can_id", "signal").agg(
        F.count("*").alias("n"), q4(F.sum("value")).alias("total"), q4(F.min("value")).alias("low"), q4(F.max("value")).alias("high")
    )


# A message whose first four bits choose what the next twelve mean; selectors 5 to 15 choose nothing.
MUX_ROWS = [
    ("default", 513, "Pack", 8, "Cell", 7, 4, False, False, 1.0, 0.0, "", "M"),
    *[("default", 513, "Pack", 8, f"Voltage_{k}", 3, 12, False, False, 0.00125, 0.0, "V", f"m{k}") for k in range(5)],
    ("default", 513, "Pack", 8, "Supplier", 23, 16, False, False, 1.0, 0.0, "", None),
]


@query(
    "c1_multiplexed_decode",
    f"""WITH b AS (SELECT session, CAST('0x'||substr(data_hex,1,2) AS BIGINT) AS b0, CAST('0x'||substr(data_hex,3,2) AS BIGINT) AS b1, CAST('0x'||substr(data_hex,5,4) AS BIGINT) AS w FROM v_can),
    x AS (SELECT session, b0//16 AS c, (b0%16*256+b1)*0.00125e0 AS v, w FROM b),
    r AS (SELECT session, 'Voltage_'||c AS signal, v FROM x WHERE c<5 UNION ALL SELECT session, 'Cell', CAST(c AS DOUBLE) FROM x WHERE c<5 UNION ALL SELECT session, 'Supplier', CAST(w AS DOUBLE) FROM x WHERE c<5
      UNION ALL SELECT session, 'layout_mismatch', NULL FROM x WHERE c>=5)
    SELECT session, signal, count(*) AS n, {s4("sum(v)")} AS total FROM r GROUP BY ALL""",
    ("v_can",),
)
def c1_mux(spark, sf):
    signals = spark.createDataFrame(MUX_ROWS, _DBC_SCHEMA + ", mux string")
    can = v_can(spark, sf).select("session", F.lit(513).cast("long").alias("can_id"), "data_hex", F.lit("default").alias("dbc"), F.lit(None).cast("string").alias("no_dbc"))
    values = decode.decode(can, signals).select("session", "signal", "value")
    missed = decode.classify(can, signals).where("outcome = 'unknown'").select("session", F.col("reason").alias("signal"), F.lit(None).cast("double").alias("value"))
    return values.unionByName(missed).groupBy("session", "signal").agg(F.count("*").alias("n"), q4(F.sum("value")).alias("total"))


# (dbc, role, signal, const, scale, offset, unit, codes)
ROLE_ROWS = [
    ("one", "speed_kph", "view", None, None, None, "mph", None),
    ("one", "rpm", "click", None, 40.0, 800.0, None, None),
    ("one", "brake_on", "error", None, None, None, None, None),
    ("one", "coolant_c", "signup", None, None, None, "degF", None),
    ("one", "prndl", "purchase", None, None, None, None, {str(i): "PRNDL"[i % 5] for i in range(0, 40)}),
    ("one", "odometer_km", None, 12.5, None, None, None, None),
    ("two", "brake_kpa", "view", None, None, None, "psi", None),
    ("two", "throttle_pct", "click", None, 0.5, None, None, None),
    ("two", "gear", "click", None, None, -1.0, None, None),
]
_ROLE_SCHEMA = "dbc string, role string, signal string, const double, scale double, offset double, unit string, codes map<string,string>"


@query(
    "c6_signal_roles",
    f"""WITH last AS (SELECT session, t_us//86400000000 AS day, CASE WHEN session < 'u5' THEN 'one' ELSE 'two' END AS dbc,
      arg_max(value, (t_us, event_id)) FILTER (WHERE signal='view') AS v, arg_max(value, (t_us, event_id)) FILTER (WHERE signal='click') AS c,
      arg_max(value, (t_us, event_id)) FILTER (WHERE signal='error') AS e, arg_max(value, (t_us, event_id)) FILTER (WHERE signal='signup') AS s,
      arg_max(value, (t_us, event_id)) FILTER (WHERE signal='purchase') AS p FROM v_signal GROUP BY ALL)
    SELECT session, day, CASE WHEN dbc='one' THEN {s4('v*1.609344e0')} END AS speed_kph, CASE WHEN dbc='one' THEN {s4('c*40.0e0+800.0e0')} END AS rpm,
      CASE WHEN dbc='one' THEN e<>0 END AS brake_on, CASE WHEN dbc='one' THEN {s4('(s-32.0e0)*5.0e0/9.0e0')} END AS coolant_c,
      CASE WHEN dbc='one' AND trunc(p) BETWEEN 0 AND 39 THEN substr('PRNDL', CAST(trunc(p) AS BIGINT)%5+1, 1) END AS prndl,
      CASE WHEN dbc='one' THEN 12.5e0 END AS odometer_km, CASE WHEN dbc='two' THEN {s4('v*6.894757e0')} END AS brake_kpa,
      CASE WHEN dbc='two' THEN {s4('c*0.5e0')} END AS throttle_pct, CASE WHEN dbc='two' THEN {s4('c-1.0e0')} END AS gear FROM last""",
    ("v_signal",),
)
def c6(spark, sf):
    roles = spark.createDataFrame(ROLE_ROWS, _ROLE_SCHEMA)
    last = v_signal(spark, sf).groupBy(
        "session", F.floor(F.col("t_us") / 86_400_000_000).alias("day"), "signal",
        F.when(F.col("session") < "u5", "one").otherwise("two").alias("dbc"),
    ).agg(F.max_by("value", F.struct("t_us", "event_id")).alias("value"))
    out = decode.apply_roles(last, roles, ["session", "day"])
    numbers = ["speed_kph", "rpm", "coolant_c", "odometer_km", "brake_kpa", "throttle_pct", "gear"]
    return out.select("session", "day", "brake_on", "prndl", *[q4(F.col(c)).alias(c) for c in numbers])


@query(
    "v6_roles_check",
    """WITH s AS (SELECT 'f'||(p_partkey%7) AS dbc, p_partkey%11 AS c, p_partkey%3 AS d FROM part), p AS (
      SELECT dbc, 'speed_kph' AS role, 'source.signal_missing' AS problem FROM s WHERE c=0 AND d=1
      UNION ALL SELECT dbc, 'rpm', 'source.not_one' FROM s WHERE c=1
      UNION ALL SELECT dbc, 'warp', 'role.unknown' FROM s WHERE c=2
      UNION ALL SELECT dbc, 'coolant_c', 'unit.wrong_kind' FROM s WHERE c=3
      UNION ALL SELECT dbc, 'coolant_c', 'unit.with_factor' FROM s WHERE c=3
      UNION ALL SELECT dbc, 'prndl', 'selector.bad_code' FROM s WHERE c=4
      UNION ALL SELECT dbc, 'cylinders', 'constant.not_number' FROM s WHERE c=5
      UNION ALL SELECT dbc, 'cylinders', 'constant.converted' FROM s WHERE c=5
      UNION ALL SELECT dbc, 'gear', 'entry.extra_key' FROM s WHERE c=6
      UNION ALL SELECT dbc, 'gear', 'number.has_codes' FROM s WHERE c=6
      UNION ALL SELECT dbc, 'rpm', 'number.scale_not_number' FROM s WHERE c=7
      UNION ALL SELECT dbc, 'prndl', 'selector.no_codes' FROM s WHERE c=8
      UNION ALL SELECT dbc, 'rpm', 'unit.unknown' FROM s WHERE c=9
      UNION ALL SELECT dbc, 'brake_on', 'entry.not_object' FROM s WHERE c=10)
    SELECT dbc, role, problem, count(*) AS n FROM p GROUP BY ALL""",
)
def v6(spark, sf):
    c, d = F.col("p_partkey") % 11, F.col("p_partkey") % 3
    cases = [
        ("speed_kph", F.when(d == 1, '{"signal":"Nope"}').otherwise('{"signal":"Known","unit":"mph"}')),
        ("rpm", '{"scale":2}'), ("warp", '{"signal":"Known"}'), ("coolant_c", '{"signal":"Known","unit":"psi","scale":1.5}'),
        ("prndl", '{"signal":"Known","map":{"1":"P","x":"R"}}'), ("cylinders", '{"value":"six","offset":1}'),
        ("gear", '{"signal":"Known","map":{"1":"P"},"colour":"red"}'), ("rpm", '{"signal":"Known","scale":"2"}'),
        ("prndl", '{"signal":"Known"}'), ("rpm", '{"signal":"Known","unit":"furlong"}'), ("brake_on", '["Known"]'),
    ]
    role, spec = F.lit(cases[-1][0]), F.lit(cases[-1][1])
    for i, (r, s) in enumerate(cases[:-1]):
        role = F.when(c == i, r).otherwise(role)
        spec = F.when(c == i, s).otherwise(spec)
    part = table(spark, sf, "part")
    specs = part.select(F.concat(F.lit("f"), F.col("p_partkey") % 7).alias("dbc"), role.alias("role"), spec.alias("spec"))
    names = part.select(F.concat(F.lit("f"), F.col("p_partkey") % 7).alias("dbc"), F.lit("Known").alias("signal"))
    return decode.check_roles(specs, names).groupBy("dbc", "role", "problem").agg(F.count("*").alias("n"))
