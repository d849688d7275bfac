"""Queries over vehicle state, drive summaries, sessions and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlake.operators import sessions as S
from roadlake.operators import state, summary
from roadlake.operators.ordered import DAY_US
from roadlake.plans.registry import even_sql, q4, query, s4
from roadlake.plans.views import events, table, v_signal, v_state
from roadlake.sources.upsert import merge

ORDER = ["t_us", "event_id"]
KEYS = ["session", "device"]
HOUR = 3_600_000_000
SIX = 6 * HOUR
CHUNK = 120_000_000

# ---- drive summary ----

_DRIVE = """
  n AS (SELECT *, lag(t_us) OVER w AS pt, lag(speed_kph) OVER w AS ps, lead(t_us) OVER w AS nt, lead(speed_kph) OVER w AS ns,
      coalesce(speed_kph>1, false) AS mov, lag(coalesce(speed_kph>1, false)) OVER w AS pmov, lag(brake_on) OVER w AS pbrk
      FROM v_state WINDOW w AS (PARTITION BY session, device ORDER BY t_us, event_id)),
  iv AS (SELECT session, device, coalesce(min((t_us-pt)/1e6), 1.0e0) AS i, count(prndl) > 0 AS sel FROM n GROUP BY 1, 2),
  g AS (SELECT n.*, i, sel, CASE WHEN abs((nt-pt)/1e6 - 2*i) <= i/2 THEN (ns-ps)/3.6e0/(2*i)/9.80665e0 END AS lon_g,
      CASE WHEN speed_kph >= 10 THEN speed_kph/3.6e0*radians(sqrt(gyro_x*gyro_x+gyro_y*gyro_y+gyro_z*gyro_z))/9.80665e0 END AS lat_g
      FROM n JOIN iv USING (session, device)),
  loc AS (SELECT *, lag(t_us) OVER w AS lt, lag(lat) OVER w AS llat, lag(lon) OVER w AS llon FROM g WHERE lat IS NOT NULL AND lon IS NOT NULL
      WINDOW w AS (PARTITION BY session, device ORDER BY t_us, event_id)),
  gear1 AS (SELECT *, CASE WHEN sel THEN coalesce(prndl='D', false) ELSE gear IS NOT NULL END AS ind FROM g),
  gear2 AS (SELECT *, CASE WHEN ind AND gear IS NOT NULL THEN 1 WHEN sel AND NOT ind THEN 0 END AS ev FROM gear1),
  gear3 AS (SELECT *, sum(CASE WHEN ev=0 THEN 1 ELSE 0 END) OVER (PARTITION BY session, device ORDER BY t_us, event_id) AS isl FROM gear2),
  gear4 AS (SELECT *, lag(gear) OVER (PARTITION BY session, device, isl ORDER BY t_us, event_id) AS pg FROM gear3 WHERE ev=1)"""


def drive(*columns: str):
    """A query over the summary of every session."""

    def run(spark, sf):
        out = summary.summarise(v_state(spark, sf), ORDER, CHUNK)
        return out.select(*KEYS, *[F.expr(c) for c in columns])

    return run


def _motion(spark, sf):
    return summary.with_motion(v_state(spark, sf), ORDER, CHUNK)


@query("w5_longitudinal_g", f"WITH {_DRIVE} SELECT event_id, {s4('lon_g')} AS lon_g FROM g", ("v_state",))
def w5(spark, sf):
    return _motion(spark, sf).select("event_id", q4(F.col("lon_g")).alias("lon_g"))


@query("w6_lateral_g", f"WITH {_DRIVE} SELECT event_id, {s4('lat_g')} AS lat_g FROM g", ("v_state",))
def w6(spark, sf):
    return _motion(spark, sf).select("event_id", q4(F.col("lat_g")).alias("lat_g"))


query(
    "w4_event_runs",
    f"""WITH {_DRIVE}, f AS (SELECT session, device, t_us, event_id, coalesce(lon_g<=-0.35e0,false) AS hb, coalesce(lon_g>=0.3e0,false) AS ha, coalesce(lat_g>=0.4e0,false) AS co,
      coalesce(brake_on,false) AS br FROM g), p AS (SELECT *, lag(hb) OVER w AS phb, lag(ha) OVER w AS pha, lag(co) OVER w AS pco, lag(br) OVER w AS pbr FROM f WINDOW w AS (PARTITION BY session, device ORDER BY t_us, event_id))
    SELECT session, device, count(*) FILTER (WHERE hb AND NOT coalesce(phb,false)) AS hard_braking, count(*) FILTER (WHERE ha AND NOT coalesce(pha,false)) AS hard_acceleration,
    count(*) FILTER (WHERE co AND NOT coalesce(pco,false)) AS sharp_cornering, count(*) FILTER (WHERE br AND NOT coalesce(pbr,false)) AS brake_applications FROM p GROUP BY 1, 2""",
    ("v_state",),
)(drive("hard_braking", "hard_acceleration", "sharp_cornering", "brake_applications"))

query(
    "w7_gps_distance",
    f"""WITH {_DRIVE} SELECT session, device, {s4('''round_even(coalesce(sum(CASE WHEN (t_us-lt)/1e6<=5 AND (CASE WHEN speed_kph IS NOT NULL THEN mov ELSE coalesce(gps_speed_kph,0)>3 END)
      THEN 2*6371.0088e0*asin(sqrt(sin(radians(lat-llat)/2)*sin(radians(lat-llat)/2)+cos(radians(llat))*cos(radians(lat))*sin(radians(lon-llon)/2)*sin(radians(lon-llon)/2))) END),0),3)''')} AS gps_km FROM loc GROUP BY 1, 2""",
    ("v_state",),
)(lambda spark, sf: drive("distance_gps_km AS gps_km")(spark, sf).withColumn("gps_km", q4(F.col("gps_km"))))

query(
    "w8_drive_totals",
    f"""WITH {_DRIVE} SELECT session, device, {s4(even_sql('(max(t_us)-min(t_us))/1e6+max(i)', 1))} AS duration_s, {s4(even_sql('count(*) FILTER (WHERE mov)*max(i)', 1))} AS moving_s,
    {s4(even_sql('count(*) FILTER (WHERE NOT mov AND rpm<>0)*max(i)', 1))} AS idle_s, count(*) FILTER (WHERE pmov AND NOT mov) AS stops,
    {s4(even_sql('sum(speed_kph)*max(i)/3600', 3))} AS can_km, {s4(even_sql('max(odometer_km)-min(odometer_km)', 3))} AS odometer_km FROM g GROUP BY 1, 2""",
    ("v_state",),
)(lambda spark, sf: drive("duration_s", "moving_s", "idle_s", "stops", "distance_can_km AS can_km", "distance_odometer_km AS odometer_km")(spark, sf).select(
    *KEYS, "stops", *[q4(F.col(c)).alias(c) for c in ("duration_s", "moving_s", "idle_s", "can_km", "odometer_km")]))


@query(
    "w9_selector_gears",
    f"""WITH {_DRIVE} SELECT session, device, 'selector' AS kind, prndl AS position, {s4(even_sql('count(*)*max(i)', 1))} AS seconds FROM g WHERE prndl IS NOT NULL GROUP BY 1,2,4
    UNION ALL SELECT session, device, 'gear', CAST(CAST(gear AS INTEGER) AS VARCHAR), {s4(even_sql('count(*)*max(i)', 1))} FROM gear4 GROUP BY 1,2,4
    UNION ALL SELECT session, device, 'shifts', CAST(NULL AS VARCHAR), CAST(count(*) FILTER (WHERE pg IS NOT NULL AND pg<>gear) AS DOUBLE) FROM gear4 GROUP BY 1,2""",
    ("v_state",),
)
def w9(spark, sf):
    out = summary.summarise(v_state(spark, sf), ORDER, CHUNK)
    none = F.lit(None).cast("string")
    selector = out.select(*KEYS, F.lit("selector").alias("kind"), F.explode("selector_s").alias("position", "seconds"))
    gears = out.select(*KEYS, F.lit("gear").alias("kind"), F.explode("gears_s").alias("g", "seconds")).select(
        *KEYS, "kind", F.col("g").cast("string").alias("position"), "seconds")
    shifts = out.select(*KEYS, F.lit("shifts").alias("kind"), none.alias("position"), F.col("shifts").cast("double").alias("seconds"))
    return selector.unionByName(gears).unionByName(shifts).withColumn("seconds", q4(F.col("seconds")))


query(
    "w10_temperatures_peaks",
    f"""WITH {_DRIVE} SELECT session, device, {s4(even_sql('arg_min(coolant_c,(t_us,event_id)) FILTER (WHERE coolant_c IS NOT NULL)', 1))} AS coolant_start,
    {s4(even_sql('max(coolant_c)', 1))} AS coolant_max, {s4(even_sql('arg_max(oil_temp_c,(t_us,event_id)) FILTER (WHERE oil_temp_c IS NOT NULL)', 1))} AS oil_end,
    {s4(even_sql('avg(speed_kph) FILTER (WHERE mov)', 1))} AS avg_moving_kph, {s4(even_sql('max(speed_kph)', 1))} AS max_can_kph, {s4(even_sql('max(gps_speed_kph)', 1))} AS max_gps_kph,
    {s4(even_sql('max(rpm)', 0))} AS max_rpm, {s4(even_sql('avg(rpm) FILTER (WHERE mov)', 0))} AS avg_rpm_moving, {s4(even_sql('count(*) FILTER (WHERE rpm>4000)*max(i)', 1))} AS seconds_above_4000,
    {s4(even_sql('max(brake_kpa)', 0))} AS max_brake_kpa, {s4(even_sql('min(lon_g)', 3))} AS peak_braking_g, {s4(even_sql('max(lon_g)', 3))} AS peak_acceleration_g, {s4(even_sql('max(lat_g)', 3))} AS peak_lateral_g
    FROM g GROUP BY 1, 2""",
    ("v_state",),
)(lambda spark, sf: (lambda d: d.select(*KEYS, *[q4(F.col(c)).alias(c) for c in d.columns if c not in KEYS]))(drive(
    "coolant_c.start AS coolant_start", "coolant_c.max AS coolant_max", "oil_temp_c.end AS oil_end", "avg_moving_kph", "max_can_kph", "max_gps_kph", "max_rpm",
    "avg_rpm_moving", "seconds_above_4000", "max_brake_kpa", "peak_braking_g", "peak_acceleration_g", "peak_lateral_g")(spark, sf)))

query(
    "w11_quality",
    f"""WITH {_DRIVE}, fr AS (SELECT session, device, frame_base_us, bool_and(complete) AS ok, arg_max(coalesce(imu_filled_in_frame,0),(t_us,event_id)) AS filled FROM g GROUP BY ALL),
    q AS (SELECT session, device, count(*) AS frames_used, count(*) FILTER (WHERE NOT ok) AS incomplete_frames, CAST(sum(filled) AS BIGINT) AS imu_points_filled FROM fr GROUP BY 1, 2)
    SELECT session, device, frames_used, incomplete_frames, imu_points_filled, (SELECT count(*) FROM g WHERE g.session=q.session AND g.device=q.device AND g.gps_fixes=0) AS intervals_without_gps,
    CASE WHEN (SELECT count(prndl) FROM g WHERE g.session=q.session AND g.device=q.device)=0 THEN 'steering_deg,prndl' ELSE 'steering_deg' END AS roles_unavailable FROM q""",
    ("v_state",),
)(drive("frames_used", "incomplete_frames", "imu_points_filled", "intervals_without_gps", "array_join(roles_unavailable, ',') AS roles_unavailable"))


@query(
    "a12_lag_quantiles",
    f"""WITH l AS (SELECT session, device, frame_base_us, arg_max(received_us,(t_us,event_id)) AS r, arg_max(written_us,(t_us,event_id)) AS w FROM v_state
      WHERE received_us IS NOT NULL AND written_us IS NOT NULL GROUP BY ALL), d AS (SELECT session, device, r-(frame_base_us+1000000) AS u, w-r AS p FROM l)
    SELECT session, device, count(*) AS frames_timed, {s4(even_sql('quantile_disc(u,0.5)/1e6', 1))} AS upload_p50_s, {s4(even_sql('quantile_disc(u,0.95)/1e6', 1))} AS upload_p95_s,
    {s4(even_sql('max(u)/1e6', 1))} AS upload_max_s, {s4(even_sql('quantile_disc(p,0.5)/1e6', 1))} AS pipeline_p50_s, {s4(even_sql('quantile_disc(p,0.95)/1e6', 1))} AS pipeline_p95_s,
    {s4(even_sql('max(p)/1e6', 1))} AS pipeline_max_s FROM d GROUP BY 1, 2""",
    ("v_state",),
)
def a12(spark, sf):
    out = summary.processing(v_state(spark, sf), ORDER)
    return out.select(*KEYS, "frames_timed", *[q4(F.col(c)).alias(c) for c in out.columns if c.endswith("_s")])


@query(
    "a13_lag_histogram",
    f"""WITH l AS (SELECT session, device, (received_us - t_us)/1e6 AS s FROM v_state WHERE received_us IS NOT NULL),
    b AS (SELECT session, device, s, len(list_filter([0.05e0,0.1e0,0.25e0,0.5e0,1e0,2e0,5e0,10e0,30e0,60e0,120e0,300e0,900e0,3600e0,14400e0,86400e0], lambda x: x < s)) AS bucket FROM l)
    SELECT session, device, CAST(bucket AS INTEGER) AS bucket, count(*) AS n, {s4('sum(s)')} AS total_s FROM b GROUP BY 1,2,3""",
    ("v_state",),
)
def a13(spark, sf):
    lag = (F.col("received_us") - F.col("t_us")) / F.lit(1e6)
    out = S.lag_histogram(v_state(spark, sf), KEYS, lag)
    return out.select(*KEYS, "bucket", "n", q4(F.col("total_s")).alias("total_s"))


@query(
    "a13_backlog",
    """SELECT 'r'||(o_custkey%5) AS reader, 't'||(o_custkey%13) AS topic, greatest(0, max(n) - (max(o_orderkey)//40 + 1)) AS backlog
    FROM orders JOIN (SELECT 't'||(l_suppkey%13) AS t, count(*) AS n FROM lineitem GROUP BY 1) ON t = 't'||(o_custkey%13) WHERE o_orderstatus <> 'P' GROUP BY ALL""",
)
def a13b(spark, sf):
    topics = table(spark, sf, "lineitem").groupBy(F.concat(F.lit("t"), F.col("l_suppkey") % 13).alias("topic")).agg(F.count("*").alias("messages"))
    offsets = table(spark, sf, "orders").groupBy(
        F.concat(F.lit("r"), F.col("o_custkey") % 5).alias("reader"), F.concat(F.lit("t"), F.col("o_custkey") % 13).alias("topic")
    ).agg(F.floor(F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))) / 40).alias("consumed_offset"))
    return S.backlog(topics, offsets)


# ---- interval state ----

def can_samples(spark, sf):
    return v_signal(spark, sf).select(
        *KEYS, (F.col("t_us") - F.pmod("t_us", F.lit(SIX))).alias("base_us"), "t_us", F.col("event_id").alias("seq"), "signal", "value"
    )


def motion_samples(spark, sf):
    e = F.col("event_id")
    axes = F.struct(*[((e * m) % 97 / F.lit(10.0)).alias(a) for a, m in zip("xyz", (3, 5, 7))])
    fix = F.struct((F.lit(40.0) + e % 100 / F.lit(1e3)).alias("lat"), F.col("value").alias("gps_speed_kph"))
    return v_signal(spark, sf).select(
        *KEYS, (F.col("t_us") - F.pmod("t_us", F.lit(SIX))).alias("base_us"), "t_us", e.alias("seq"),
        F.when(e % 3 == 0, fix).alias("fix"), F.when(e % 3 == 1, axes).alias("accel"), F.when(e % 3 == 1, axes).alias("gyro"),
    )


_PLACED = "SELECT *, t_us - t_us%21600000000 AS base_us, t_us - t_us%10800000000 AS start_us FROM v_signal"


@query(
    "a6_interval_stats",
    f"""WITH p AS ({_PLACED}) SELECT session, device, start_us, signal, {s4('min(value)')} AS low, {s4('max(value)')} AS high, {s4('avg(value)')} AS mean, count(*) AS n,
    {s4('arg_max(value,(t_us,event_id))')} AS last_value, max(t_us) AS seen_us FROM p GROUP BY ALL""",
    ("v_signal",),
)
def a6(spark, sf):
    out = state.signal_intervals(state.place(can_samples(spark, sf), 3 * HOUR, SIX))
    return out.select(*KEYS, "start_us", "signal", q4(F.col("min")).alias("low"), q4(F.col("max")).alias("high"), q4(F.col("mean")).alias("mean"),
                      F.col("count").alias("n"), q4(F.col("last")).alias("last_value"), "seen_us")


@query(
    "a7_last_value",
    f"""WITH p AS ({_PLACED}) SELECT session, device, start_us, {s4('arg_max(40.0e0+event_id%100/1e3,(t_us,event_id)) FILTER (WHERE event_id%3=0)')} AS lat,
    count(*) FILTER (WHERE event_id%3=0) AS gps_fixes, count(*) FILTER (WHERE event_id%3=1) AS imu_samples, {s4('avg(event_id*3%97/10.0e0) FILTER (WHERE event_id%3=1)')} AS accel_x_mean,
    {s4('max(event_id*7%97/10.0e0) FILTER (WHERE event_id%3=1)')} AS gyro_z_max, {s4('min(event_id*5%97/10.0e0) FILTER (WHERE event_id%3=1)')} AS accel_y_min FROM p GROUP BY ALL""",
    ("v_signal",),
)
def a7(spark, sf):
    out = state.motion_intervals(state.place(motion_samples(spark, sf), 3 * HOUR, SIX))
    return out.select(*KEYS, "start_us", q4(F.col("fix.lat")).alias("lat"), "gps_fixes", "imu_samples", q4(F.col("accel_mean.x")).alias("accel_x_mean"),
                      q4(F.col("gyro_max.z")).alias("gyro_z_max"), q4(F.col("accel_min.y")).alias("accel_y_min"))


_CARRY = f"""WITH p AS ({_PLACED}), obs AS (SELECT session, device, signal, start_us, arg_max(value,(t_us,event_id)) AS v, max(t_us) AS seen FROM p GROUP BY ALL),
    fr AS (SELECT DISTINCT session, device, base_us FROM p), iv AS (SELECT session, device, base_us + i*10800000000 AS start_us FROM fr, range(2) r(i)),
    sg AS (SELECT DISTINCT session, device, signal FROM obs), grid AS (SELECT * FROM iv JOIN sg USING (session, device)),
    held AS (SELECT g.session, g.device, g.signal, g.start_us, o.v, o.seen FROM grid g ASOF JOIN obs o ON g.session=o.session AND g.device=o.device AND g.signal=o.signal AND g.start_us>=o.start_us)"""


@query(
    "w1_carry_forward",
    _CARRY + f""" SELECT session, device, start_us, signal, {s4('v')} AS value, CASE WHEN seen<start_us THEN (start_us+10800000000-seen)//1000 END AS age_ms FROM held""",
    ("v_signal",),
)
def w1(spark, sf):
    can = can_samples(spark, sf)
    rows = state.intervals(can.select(*KEYS, "base_us").distinct(), 3 * HOUR, SIX)
    out = state.carry_forward(rows, state.signal_intervals(state.place(can, 3 * HOUR, SIX)), 3 * HOUR, 15 * DAY_US)
    flat = out.select(*KEYS, "start_us", "carried", F.explode("signals").alias("signal", "value"))
    return flat.select(*KEYS, "start_us", "signal", q4(F.col("value")).alias("value"), F.try_element_at("carried", F.col("signal")).alias("age_ms"))


def _receipts(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").where(k % 13 != 0).select(
        F.concat(F.lit("c"), F.col("o_custkey") % 50).alias("session"), F.concat(F.lit("d"), k % 3).alias("device"), (k * 1_000_000).alias("base_us"),
        (k * 1_000_000 + 2_000_000).alias("received_us"), F.lit(1).alias("gps"), (k % 3).alias("imu"), (k % 4 + 1).alias("can"), F.lit(0).alias("imu_missing"),
    )


def _frame_samples(spark, sf):
    k, ln = F.col("o_orderkey"), F.col("l_linenumber")
    kinds = F.when(ln == 1, "gps").when(ln == 2, "imu").when(ln == 3, "can").when(ln == 4, "unknown").when(ln == 5, "discovery").otherwise("can")
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == k)
    return joined.select(
        F.concat(F.lit("c"), F.col("o_custkey") % 50).alias("session"), F.concat(F.lit("d"), k % 3).alias("device"), (k * 1_000_000).alias("base_us"),
        kinds.alias("kind"), (k * 1_000_000 + ln * 1000).alias("received_us"),
    )


@query(
    "j2_frame_completeness",
    """WITH s AS (SELECT o_orderkey AS k, CASE l_linenumber WHEN 1 THEN 'gps' WHEN 2 THEN 'imu' WHEN 4 THEN 'unknown' WHEN 5 THEN 'discovery' ELSE 'can' END AS kind FROM lineitem JOIN orders ON l_orderkey=o_orderkey),
    c AS (SELECT k, count(*) FILTER (WHERE kind='gps') AS g, count(*) FILTER (WHERE kind='imu') AS i, count(*) FILTER (WHERE kind NOT IN ('gps','imu')) AS n FROM s GROUP BY 1),
    r AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey%13<>0), a AS (SELECT coalesce(c.k, r.k) AS k, coalesce(g,0) AS g, coalesce(i,0) AS i, coalesce(n,0) AS n, r.k IS NOT NULL AS rec, c.k IS NOT NULL AS has FROM c FULL JOIN r ON c.k=r.k)
    SELECT k*1000000 AS base_us, CASE WHEN rec AND g=1 AND i=k%3 AND n=k%4+1 THEN 'complete' WHEN has THEN 'incomplete' ELSE 'empty' END AS status, g AS n_gps, i AS n_imu FROM a""",
)
def j2(spark, sf):
    return state.frame_status(_frame_samples(spark, sf), _receipts(spark, sf)).select("base_us", "status", "n_gps", "n_imu")


@query(
    "a13_frames_by_status",
    """WITH s AS (SELECT o_orderkey AS k, CASE l_linenumber WHEN 1 THEN 'gps' WHEN 2 THEN 'imu' ELSE 'can' END AS kind FROM lineitem JOIN orders ON l_orderkey=o_orderkey),
    c AS (SELECT k, count(*) FILTER (WHERE kind='gps') AS g, count(*) FILTER (WHERE kind='imu') AS i, count(*) FILTER (WHERE kind='can') AS n FROM s GROUP BY 1),
    r AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey%13<>0), a AS (SELECT coalesce(c.k, r.k) AS k, g, i, n, r.k IS NOT NULL AS rec, c.k IS NOT NULL AS has FROM c FULL JOIN r ON c.k=r.k)
    SELECT CASE WHEN rec AND g=1 AND i=k%3 AND n=k%4+1 THEN 'complete' WHEN has THEN 'incomplete' ELSE 'empty' END AS status, count(*) AS frames FROM a GROUP BY 1""",
)
def a13_status(spark, sf):
    return S.frames_by_status(state.frame_status(_frame_samples(spark, sf), _receipts(spark, sf)), [])


@query(
    "v7_eligibility",
    """SELECT coalesce(CASE WHEN event_id%31=0 OR user_id%20=0 OR event_id%37=0 THEN 'no session' WHEN event_id%11=0 THEN 'untagged' WHEN epoch_us(ts)<=1704500000000000 + user_id*1000000 THEN 'late' END,'ok') AS verdict, count(*) AS n FROM events GROUP BY 1""",
)
def v7(spark, sf):
    e = F.col("event_id")
    rows = events(spark, sf).select(
        F.when(e % 31 == 0, " ").when(F.col("user_id") % 20 == 0, "proto-live").otherwise("u").alias("session"), F.when(e % 37 != 0, "d").alias("device"),
        F.when(e % 11 != 0, F.col("t_us")).alias("base_us"), (F.lit(1_704_500_000_000_000) + F.col("user_id") * 1_000_000).alias("closed"),
    )
    return rows.groupBy(F.coalesce(state.eligibility(F.col("closed")), F.lit("ok")).alias("verdict")).agg(F.count("*").alias("n"))


# ---- sessions ----

NOW = 40_000_000_000


def session_records(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kind = F.when(k % 10 == 0, "session_start").when(k % 10 == 1, "session_end").when(k % 10 == 2, "heartbeat").otherwise("frame")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("c"), c % 400).alias("session"), F.concat(F.lit("d"), c % 2).alias("device"), k.alias("arrival"), kind.alias("message_type"),
        F.when(k % 7 == 0, F.concat(F.lit("acct"), c % 400 % 6)).alias("user_sub"), F.col("o_orderpriority").alias("mode"), (c % 30).alias("vehicle_id"),
        (k % 40).alias("track_id"), (k * 1_000_000).alias("started_us"), F.when(k % 20 == 1, k * 1_000_000 + 500).alias("ended_us"), F.col("o_orderstatus").alias("end_reason"),
        (k % 25).alias("frames_expected"), k.alias("first_frame_us"), k.alias("last_frame_us"), (k % 12 * 1_000_000).alias("base_us"),
        (k * 1_000_000 * 3 - k % 5 * 10_000_000).alias("received_us"),
    )


def rolled(spark, sf):
    tracks = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("track_id"))
    return S.roll_up(session_records(spark, sf), tracks)


_ROLL = """
  rec AS (SELECT 'c'||(o_custkey%400) AS session, 'd'||(o_custkey%2) AS device, o_orderkey AS k, CASE o_orderkey%10 WHEN 0 THEN 's' WHEN 1 THEN 'e' WHEN 2 THEN 'h' ELSE 'f' END AS kind,
      CASE WHEN o_orderkey%7=0 THEN 'acct'||(o_custkey%400%6) END AS u, o_orderpriority AS mode, o_custkey%30 AS vehicle_id, o_orderkey%12*1000000 AS base_us,
      o_orderkey*3000000 - o_orderkey%5*10000000 AS received_us, o_orderstatus FROM orders WHERE o_orderkey%10<>2),
  fr AS (SELECT session, device, base_us, count(*) AS n, arg_min(received_us, k) AS r FROM rec WHERE kind='f' GROUP BY ALL),
  fs AS (SELECT session, device, count(*) AS frames_received, CAST(sum(n-1) AS BIGINT) AS duplicates, max(r) AS last_frame_received_us FROM fr GROUP BY ALL),
  se AS (SELECT session, device, max(k) FILTER (WHERE kind='s') AS ks, max(k) FILTER (WHERE kind='e') AS ke, arg_max(u, k) FILTER (WHERE u IS NOT NULL) AS user_sub,
      arg_max(mode, k) FILTER (WHERE kind='s') AS mode, arg_max(vehicle_id, k) FILTER (WHERE kind='s') AS vehicle_id, arg_max(o_orderstatus, k) FILTER (WHERE kind='e') AS end_reason FROM rec GROUP BY ALL),
  ses AS (SELECT session, device, user_sub, mode, vehicle_id, CASE WHEN ks%40<25 THEN ks%40 END AS track_id, ks*1000000 AS started_us, CASE WHEN ke%20=1 THEN ke*1000000+500 END AS ended_us, end_reason,
      ke%25 AS frames_expected, coalesce(frames_received,0) AS frames_received, coalesce(duplicates,0) AS duplicates, last_frame_received_us FROM se LEFT JOIN fs USING (session, device)),
  st AS (SELECT *, CASE WHEN ended_us IS NOT NULL THEN CASE WHEN coalesce(frames_received>=frames_expected,false) THEN 'complete' ELSE 'incomplete' END
      WHEN greatest(last_frame_received_us, started_us) IS NULL OR 40000000000-greatest(last_frame_received_us, started_us) > 1800000000 THEN 'unterminated' ELSE 'open' END AS state,
      CASE WHEN frames_expected=0 THEN 100.0e0 ELSE round_even(least(frames_received,frames_expected)*100.0e0/nullif(frames_expected,0),1) END AS pct FROM ses),
  summ AS (SELECT DISTINCT 'c'||c_custkey AS session, 'd'||(c_custkey%2) AS device, 2+c_custkey%2 AS version, c_custkey%10 AS frames, c_acctbal AS distance_km, CAST(c_custkey AS DOUBLE) AS duration_s,
      CASE WHEN c_custkey%4=0 THEN NULL ELSE c_acctbal/100.0e0 END AS mc, c_acctbal/50.0e0 AS mg FROM customer WHERE c_custkey%3<>0)"""


def _summaries(spark, sf):
    c = F.col("c_custkey")
    return table(spark, sf, "customer").where(c % 3 != 0).select(
        F.concat(F.lit("c"), c).alias("session"), F.concat(F.lit("d"), c % 2).alias("device"), (c % 2 + 2).alias("version"), (c % 10).alias("frames_received"),
        F.col("c_acctbal").alias("distance_km"), c.cast("double").alias("duration_s"), F.when(c % 4 != 0, F.col("c_acctbal") / 100.0).alias("max_can_kph"), (F.col("c_acctbal") / 50.0).alias("max_gps_kph"),
    )


@query(
    "a8_session_rollup",
    f"WITH {_ROLL} SELECT session, device, user_sub, mode, vehicle_id, track_id, started_us, ended_us, end_reason, frames_expected, frames_received, duplicates, last_frame_received_us FROM ses",
)
def a8(spark, sf):
    return rolled(spark, sf).drop("first_frame_us", "last_frame_us")


@query("f1_session_state", f"WITH {_ROLL} SELECT session, device, state, pct AS completeness_pct FROM st")
def f1(spark, sf):
    return rolled(spark, sf).select(*KEYS, S.state(F.lit(NOW)).alias("state"), S.completeness_pct().alias("completeness_pct"))


@query(
    "j14_track_check",
    """SELECT o_orderkey, CASE WHEN o_orderkey%40<25 THEN o_orderkey%40 END AS track_id FROM orders""",
)
def j14(spark, sf):
    tracks = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("track_id"))
    return S.known_tracks(table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 40).alias("track_id")), tracks)


def _listed(spark, sf):
    vehicles = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("vehicle_id"), F.col("n_name").alias("vehicle_name"))
    return S.listing(rolled(spark, sf), vehicles, _summaries(spark, sf))


_LISTED = _ROLL + ", lst AS (SELECT st.*, n_name AS vehicle_name, distance_km, duration_s, coalesce(mc, mg) AS max_kph FROM st LEFT JOIN nation ON n_nationkey=vehicle_id LEFT JOIN summ ON summ.session=st.session AND summ.device=st.device)"


@query("j11_session_listing", f"WITH {_LISTED} SELECT session, device, vehicle_name, distance_km, duration_s, {s4('max_kph')} AS max_kph FROM lst")
def j11(spark, sf):
    return _listed(spark, sf).select(*KEYS, "vehicle_name", "distance_km", "duration_s", q4(F.col("max_kph")).alias("max_kph"))


@query(
    "t1_session_page",
    f"WITH {_LISTED} SELECT session, device, state, pct AS completeness_pct, vehicle_name, started_us FROM lst WHERE user_sub='acct3' ORDER BY started_us DESC NULLS LAST, session DESC, device DESC LIMIT 30 OFFSET 5",
)
def t1(spark, sf):
    return S.page(_listed(spark, sf), "acct3", F.lit(NOW), 30, 5).select(*KEYS, "state", "completeness_pct", "vehicle_name", "started_us")


@query(
    "t5_pending_summaries",
    f"""WITH {_ROLL} SELECT ses.session, ses.device FROM ses LEFT JOIN summ ON summ.session=ses.session AND summ.device=ses.device
    WHERE (ended_us IS NOT NULL OR last_frame_received_us < 40000000000-1800000000) AND (last_frame_received_us IS NULL OR last_frame_received_us < 40000000000-120000000)
    AND (version IS NULL OR version<3 OR frames<>frames_received)""",
)
def t5(spark, sf):
    return S.pending_summaries(rolled(spark, sf), _summaries(spark, sf), F.lit(NOW)).select(*KEYS)


@query(
    "j10_missing_frames",
    """SELECT DISTINCT 'c'||(o_custkey%40) AS session, 'd'||(o_custkey%3) AS device, o_orderkey//4*1000000 AS base_us FROM orders WHERE ('c'||(o_custkey%40), 'd'||(o_custkey%3), o_orderkey//4*1000000) NOT IN
    (SELECT ('c'||(l_suppkey%40), 'd'||(l_suppkey%3), l_orderkey//4*1000000) FROM lineitem)""",
)
def j10(spark, sf):
    def keyed(name, key, base):
        return table(spark, sf, name).select(
            F.concat(F.lit("c"), F.col(key) % 40).alias("session"), F.concat(F.lit("d"), F.col(key) % 3).alias("device"), (F.floor(F.col(base) / 4) * 1_000_000).alias("base_us"))

    return S.missing_frames(keyed("orders", "o_custkey", "o_orderkey"), keyed("lineitem", "l_suppkey", "l_orderkey"))


@query(
    "u2_first_by_key",
    "SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2",
)
def u2(spark, sf):
    return S.first_by_key(table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "u3_delete_session",
    f"""WITH {_ROLL} SELECT session, device, count(*) AS n FROM rec WHERE NOT EXISTS (SELECT 1 FROM ses WHERE ses.session=rec.session AND ses.device=rec.device AND mode='1-URGENT'
      AND NOT (ended_us IS NULL AND coalesce(40000000000-last_frame_received_us<300000000,false))) GROUP BY 1, 2""",
)
def u3(spark, sf):
    sessions = rolled(spark, sf)
    rows = session_records(spark, sf).where("message_type <> 'heartbeat'")
    kept = S.without_sessions(rows, sessions.where("mode = '1-URGENT'"), sessions, F.lit(NOW))
    return kept.groupBy(*KEYS).agg(F.count("*").alias("n"))


@query(
    "a16_device_rollup",
    """WITH h AS (SELECT 'd'||(user_id%40) AS device, epoch_us(ts) AS t_us, event_id, CASE WHEN event_id%3=0 AND user_id%50<35 THEN 'a'||(user_id%50) END AS u FROM events),
    o AS (SELECT device, min(t_us) AS created_us, max(t_us) AS last_seen_us, arg_min(u, (t_us, event_id)) FILTER (WHERE u IS NOT NULL) AS owner FROM h GROUP BY 1)
    SELECT device, created_us, last_seen_us, owner, (SELECT count(*) FROM h WHERE h.device=o.device AND h.u<>o.owner) AS conflicts FROM o""",
)
def a16(spark, sf):
    beats = events(spark, sf).select(
        F.concat(F.lit("d"), F.col("user_id") % 40).alias("device"), "t_us", F.col("event_id").alias("arrival"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("a"), F.col("user_id") % 50)).alias("user_sub"),
    )
    accounts = beats.select("user_sub").distinct().where(F.substring("user_sub", 2, 9).cast("int") < 35)
    return S.device_roll_up(beats, accounts)


# ---- upserts ----

def _versions(spark, sf):
    rows = events(spark, sf).select(
        F.concat(F.lit("u"), "user_id").alias("session"), F.floor(F.col("t_us") / DAY_US).alias("day"), "event_id", F.col("event_type").alias("kind"),
        F.when(F.col("event_id") % 5 == 0, F.col("value")).alias("length_m"), (F.col("event_id") % 50).alias("frames"),
    )
    return rows.where("event_id % 3 = 0"), rows.where("event_id % 3 <> 0")


_VERSIONS = """v AS (SELECT 'u'||user_id AS session, epoch_us(ts)//86400000000 AS day, event_id, event_type AS kind, CASE WHEN event_id%5=0 THEN value END AS length_m,
    event_id%50 AS frames, CASE WHEN event_id%3=0 THEN 0 ELSE 1 END AS gen FROM events)"""


def _merged(**policy):
    def run(spark, sf):
        old, new = _versions(spark, sf)
        return merge(old, new, ["session", "day"], ["event_id"], **policy)

    return run


query("s14_upsert_replace", f"WITH {_VERSIONS} SELECT session, day, arg_max(event_id,(gen,event_id)) AS event_id, arg_max(kind,(gen,event_id)) AS kind, arg_max(frames,(gen,event_id)) AS frames, arg_max(struct_pack(l:=length_m),(gen,event_id)).l AS length_m FROM v GROUP BY 1, 2")(_merged())
query("s14_upsert_keep_known", f"WITH {_VERSIONS} SELECT session, day, arg_max(event_id,(gen,event_id)) AS event_id, arg_max(kind,(gen,event_id)) AS kind, arg_max(frames,(gen,event_id)) AS frames, arg_max(length_m,(gen,event_id)) FILTER (WHERE length_m IS NOT NULL) AS length_m FROM v GROUP BY 1, 2")(_merged(keep_known=("length_m",)))
query("s14_upsert_guarded", f"WITH {_VERSIONS} SELECT session, day, arg_max(event_id,(frames,gen,event_id)) AS event_id, arg_max(kind,(frames,gen,event_id)) AS kind, arg_max(frames,(frames,gen,event_id)) AS frames, arg_max(struct_pack(l:=length_m),(frames,gen,event_id)).l AS length_m FROM v GROUP BY 1, 2")(_merged(guard="frames"))
