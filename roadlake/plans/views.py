"""Telemetry-shaped views over the driver's tables, in Spark and (the same arithmetic) in SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions.clock import epoch_us


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread_table(spark: SparkSession, sf: str, name: str, columns: list[str], keys: list[str]) -> DataFrame:
    """A table for work that is heavy per row. A table of many splits is read as it is; one that comes in fewer splits
    than there are cores, such as a single small file, is first spread over them by its keys."""
    rows = table(spark, sf, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, *keys)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("t_us", epoch_us(F.col("ts")))


def v_signal(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        "event_id",
        F.concat(F.lit("u"), "user_id").alias("session"),
        F.concat(F.lit("d"), F.col("user_id") % 10).alias("device"),
        F.col("event_type").alias("signal"),
        "value",
        "t_us",
    )


def v_gps(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    rows = spread_table(spark, sf, "events", ["event_id", "ts", "user_id", "value"], ["event_id"])
    return rows.withColumn("t_us", epoch_us(F.col("ts"))).select(
        "event_id",
        F.concat(F.lit("u"), "user_id").alias("session"),
        F.concat(F.lit("d"), F.col("user_id") % 10).alias("device"),
        "t_us",
        (F.lit(40.0) + (e * 37 % 1000) / F.lit(1e5)).alias("lat"),
        (F.lit(-111.0) + (e * 91 % 1000) / F.lit(1e5)).alias("lon"),
        F.col("value").alias("speed"),
        (e % 360).cast("double").alias("heading"),
    )


def v_trackpos(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        "event_id",
        F.concat(F.lit("u"), "user_id").alias("session"),
        F.concat(F.lit("d"), F.col("user_id") % 10).alias("device"),
        "t_us",
        (F.floor(F.col("t_us") / 1_000_000) % 432_000 / F.lit(432.0)).alias("s_m"),
        F.lit(1000.0).alias("track_length_m"),
        F.lit(1).cast("long").alias("track_id"),
        F.lit("oval").alias("track_name"),
        F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("speed"),
    )


def v_can(spark: SparkSession, sf: str) -> DataFrame:
    def field(value):
        return F.lpad(F.lower(F.hex(value.cast("long") % 65536)), 4, "0")

    ln = F.col("l_linenumber").cast("long")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return spread_table(spark, sf, "lineitem", columns, ["l_orderkey"]).select(
        (F.col("l_orderkey") * 1_000_000).alias("base_us"),
        (ln * 20_000).alias("dt_us"),
        (F.col("l_orderkey") * 1_000_000 + ln * 20_000).alias("t_us"),
        (ln + 512).alias("can_id"),
        F.concat(
            field(F.col("l_partkey")), field(F.col("l_suppkey")), field(F.round(F.col("l_quantity") * 100)), field(ln)
        ).alias("data_hex"),
        F.concat(F.lit("s"), F.col("l_orderkey") % 97).alias("session"),
        F.concat(F.lit("d"), F.col("l_orderkey") % 10).alias("device"),
        (F.col("l_extendedprice") * 100).cast("long").alias("seq"),
    )


def v_state(spark: SparkSession, sf: str) -> DataFrame:
    """Vehicle state rows on a one-second grid, with holes: 37 sessions that grow with the events table."""
    e = F.col("event_id")
    t = F.lit(1_700_000_000_000_000) + F.floor(e / 37) * 1_000_000
    return events(spark, sf).where(e % 29 != 5).withColumn("t_us", t).select(
        "event_id",
        F.concat(F.lit("s"), e % 37).alias("session"),
        F.concat(F.lit("d"), e % 37 % 5).alias("device"),
        "t_us",
        (F.col("t_us") - F.pmod("t_us", F.lit(2_000_000))).alias("frame_base_us"),
        F.when(e % 17 != 0, F.when(e % 4 == 0, F.lit(0.0)).otherwise(F.col("value"))).alias("speed_kph"),
        F.when(e % 19 != 0, F.lit(800.0) + F.col("value") * 40.0).alias("rpm"),
        F.when(e % 5 != 0, e % 100).cast("double").alias("throttle_pct"),
        (F.col("event_type") == "error").alias("brake_on"),
        F.when(e % 6 != 0, (e * 7 % 160).cast("double")).alias("brake_kpa"),
        F.when(e % 8 != 0, e % 4 + 1).cast("double").alias("gear"),
        F.lit(None).cast("double").alias("steering_deg"),
        F.when(e % 9 != 0, e / F.lit(100.0)).alias("odometer_km"),
        F.when(e % 7 != 0, (e % 90).cast("double")).alias("coolant_c"),
        F.when(e % 11 != 0, (e % 120).cast("double")).alias("oil_temp_c"),
        F.when(e % 37 % 3 != 0, F.when(e % 10 < 7, "D").when(e % 10 == 7, "P").when(e % 10 == 8, "R")).alias("prndl"),
        F.when(e % 12 != 0, F.lit(40.0) + (e * 37 % 1000) / F.lit(1e5)).alias("lat"),
        F.when(e % 12 != 0, F.lit(-111.0) + (e * 91 % 1000) / F.lit(1e5)).alias("lon"),
        F.when(e % 3 != 0, F.col("value") * 0.5).alias("gps_speed_kph"),
        (e % 3).alias("gps_fixes"),
        F.when(e % 14 != 0, F.struct(*[(e % m).cast("double").alias(a) for a, m in zip("xyz", (40, 23, 11))])).alias("gyro_mean"),
        F.when(e % 15 != 0, e % 5).alias("imu_filled_in_frame"),
        (e % 21 != 0).alias("complete"),
        F.when(e % 16 != 0, F.col("t_us") + e % 1000 * 10_000 + 3_600_000).alias("received_us"),
        F.when(e % 18 != 0, F.col("t_us") + e % 1000 * 12_000 + 5_600_000).alias("written_us"),
    )


# The closed line all track queries use: a fixed twelve-point loop around (40.005, -110.995).
TRACK_POINTS = [
    (40.0000, -111.0000), (40.0000, -110.9970), (40.0005, -110.9940), (40.0020, -110.9910),
    (40.0050, -110.9900), (40.0080, -110.9910), (40.0095, -110.9940), (40.0100, -110.9970),
    (40.0095, -110.9990), (40.0070, -111.0000), (40.0030, -111.0005), (40.0000, -111.0000),
]

_SQL = {
    "v_signal": """SELECT event_id, 'u'||user_id AS session, 'd'||(user_id % 10) AS device, event_type AS signal, value,
        epoch_us(ts) AS t_us FROM events""",
    "v_gps": """SELECT event_id, 'u'||user_id AS session, 'd'||(user_id % 10) AS device, epoch_us(ts) AS t_us,
        40.0e0 + (event_id*37 % 1000)/1e5 AS lat, -111.0e0 + (event_id*91 % 1000)/1e5 AS lon, value AS speed,
        CAST(event_id % 360 AS DOUBLE) AS heading FROM events""",
    "v_trackpos": """SELECT event_id, 'u'||user_id AS session, 'd'||(user_id % 10) AS device, epoch_us(ts) AS t_us,
        ((epoch_us(ts)//1000000) % 432000)/432.0e0 AS s_m, 1000.0e0 AS track_length_m, CAST(1 AS BIGINT) AS track_id,
        'oval' AS track_name, CASE WHEN event_id % 13 <> 0 THEN value END AS speed FROM events""",
    "v_can": """SELECT l_orderkey*1000000 AS base_us, CAST(l_linenumber AS BIGINT)*20000 AS dt_us,
        l_orderkey*1000000 + CAST(l_linenumber AS BIGINT)*20000 AS t_us, CAST(l_linenumber AS BIGINT)+512 AS can_id,
        printf('%04x', l_partkey % 65536)||printf('%04x', l_suppkey % 65536)
        ||printf('%04x', CAST(round(l_quantity*100) AS BIGINT) % 65536)||printf('%04x', CAST(l_linenumber AS BIGINT)) AS data_hex,
        's'||(l_orderkey % 97) AS session, 'd'||(l_orderkey % 10) AS device,
        CAST(trunc(l_extendedprice*100) AS BIGINT) AS seq FROM lineitem""",
    "v_state": """SELECT event_id, 's'||(event_id%37) AS session, 'd'||(event_id%37%5) AS device, t_us, t_us - t_us%2000000 AS frame_base_us,
        CASE WHEN event_id%17<>0 THEN CASE WHEN event_id%4=0 THEN 0.0e0 ELSE value END END AS speed_kph,
        CASE WHEN event_id%19<>0 THEN 800.0e0 + value*40.0e0 END AS rpm,
        CAST(CASE WHEN event_id%5<>0 THEN event_id%100 END AS DOUBLE) AS throttle_pct,
        event_type = 'error' AS brake_on,
        CAST(CASE WHEN event_id%6<>0 THEN event_id*7%160 END AS DOUBLE) AS brake_kpa,
        CAST(CASE WHEN event_id%8<>0 THEN event_id%4+1 END AS DOUBLE) AS gear,
        CAST(NULL AS DOUBLE) AS steering_deg,
        CASE WHEN event_id%9<>0 THEN event_id/100.0e0 END AS odometer_km,
        CAST(CASE WHEN event_id%7<>0 THEN event_id%90 END AS DOUBLE) AS coolant_c,
        CAST(CASE WHEN event_id%11<>0 THEN event_id%120 END AS DOUBLE) AS oil_temp_c,
        CASE WHEN event_id%37%3<>0 THEN CASE WHEN event_id%10<7 THEN 'D' WHEN event_id%10=7 THEN 'P' WHEN event_id%10=8 THEN 'R' END END AS prndl,
        CASE WHEN event_id%12<>0 THEN 40.0e0 + (event_id*37 % 1000)/1e5 END AS lat,
        CASE WHEN event_id%12<>0 THEN -111.0e0 + (event_id*91 % 1000)/1e5 END AS lon,
        CASE WHEN event_id%3<>0 THEN value*0.5e0 END AS gps_speed_kph,
        event_id%3 AS gps_fixes,
        CAST(CASE WHEN event_id%14<>0 THEN event_id%40 END AS DOUBLE) AS gyro_x,
        CAST(CASE WHEN event_id%14<>0 THEN event_id%23 END AS DOUBLE) AS gyro_y,
        CAST(CASE WHEN event_id%14<>0 THEN event_id%11 END AS DOUBLE) AS gyro_z,
        CASE WHEN event_id%15<>0 THEN event_id%5 END AS imu_filled_in_frame,
        event_id%21<>0 AS complete,
        CASE WHEN event_id%16<>0 THEN t_us + event_id%1000*10000 + 3600000 END AS received_us,
        CASE WHEN event_id%18<>0 THEN t_us + event_id%1000*12000 + 5600000 END AS written_us
        FROM (SELECT *, 1700000000000000 + (event_id//37)*1000000 AS t_us FROM events) WHERE event_id%29<>5""",
    "v_track": "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, {a[0]!r}e0, {a[1]!r}e0, {b[0]!r}e0, {b[1]!r}e0)" for i, (a, b) in enumerate(zip(TRACK_POINTS, TRACK_POINTS[1:]))
    ) + ") t(seq, lat1, lon1, lat2, lon2)",
}


def with_views(sql: str, *names: str) -> str:
    """The query text with the named views in front of it, as common table expressions."""
    ctes = ", ".join(f"{n} AS ({_SQL[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"
