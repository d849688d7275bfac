"""Streaming queries: each reads its table through readStream to the end, writes a table and returns it."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlake.functions.clock import epoch_us
from roadlake.operators.lap_machine import Profile
from roadlake.operators.route import route
from roadlake.operators.speed import average_speed_stream
from roadlake.operators import sessions as S
from roadlake.plans import decoding, drives, driving, signals, views
from roadlake.plans.driving import _LAP_SQL
from roadlake.plans.registry import q4, query, s4
from roadlake.plans.views import table
from roadlake.sources import archive, upsert
from roadlake.streaming import buckets, carry, decode, dimension, frames, laps, rates, rollup, sessions, windows
from roadlake.streaming.run import large_state, replayed, run_to_table, work_dir


def event_stream(spark, sf):
    """The events in six micro-batches, in the order of their time."""
    return replayed(views.events(spark, sf), "t_us")


def _signal_stream(spark, sf):
    e = event_stream(spark, sf)
    return e.select("event_id", F.concat(F.lit("u"), "user_id").alias("session"), F.concat(F.lit("d"), F.col("user_id") % 10).alias("device"),
                    F.col("event_type").alias("signal"), "value", "t_us")


@query(
    "st1_speed_stream",
    f"""SELECT device, CAST(t_us - t_us % 10000000 AS BIGINT) AS window_start_us, {s4('avg(value)')} AS average_speed, count(*) AS samples, arg_max(session, (t_us, event_id)) AS session
    FROM v_signal GROUP BY device, t_us - t_us % 10000000 HAVING max(t_us - t_us % 10000000) + 10000000 <= (SELECT (max(t_us)//1000)*1000 - 5000000 FROM v_signal)""",
    ("v_signal",),
)
def st1(spark, sf):
    out = run_to_table(average_speed_stream(_signal_stream(spark, sf).withColumnRenamed("value", "speed")))
    return out.select("device", "window_start_us", q4(F.col("average_speed")).alias("average_speed"), "samples", "session")


@query(
    "st7_second_buckets",
    """SELECT device, CAST(t_us - t_us % 1000000 AS BIGINT) AS second_us, count(*) AS samples, count(*) FILTER (WHERE signal IN ('view','error')) AS n_can, count(*) FILTER (WHERE signal='click') AS n_imu
    FROM v_signal GROUP BY device, t_us - t_us % 1000000 HAVING max(t_us - t_us % 1000000) + 1000000 <= (SELECT (max(t_us)//1000)*1000 - 1500000 FROM v_signal)""",
    ("v_signal",),
)
def st7(spark, sf):
    kind = F.when(F.col("signal").isin("view", "error"), "can").when(F.col("signal") == "click", "imu").otherwise("gps")
    return run_to_table(buckets.second_buckets(_signal_stream(spark, sf).withColumn("kind", kind))).select("device", "second_us", "samples", "n_can", "n_imu")


@query(
    "st10_route_stream",
    f"WITH {signals._ROUTED_SQL} SELECT topic, rule_id, signal, count(*) AS n FROM routed GROUP BY 1, 2, 3",
    ("v_signal",),
)
def st10(spark, sf):
    routed = route(_signal_stream(spark, sf), signals.RULES).where("topic IS NOT NULL").select("topic", "rule_id", "signal", "event_id")
    return run_to_table(routed).groupBy("topic", "rule_id", "signal").agg(F.count("*").alias("n"))


@query("st_dedupe_stream", "SELECT DISTINCT user_id % 20 AS k, event_type, epoch_us(ts)//86400000000 AS day FROM events")
def dedupe(spark, sf):
    rows = event_stream(spark, sf).select((F.col("user_id") % 20).alias("k"), "event_type", "t_us")
    keyed = rows.withColumn("day", F.floor(F.col("t_us") / 86_400_000_000))
    return run_to_table(buckets.first_in_stream(keyed, ["k", "event_type", "day"], "t_us", "2 days")).select("k", "event_type", "day")


@query(
    "st12_archive_stream",
    """SELECT 'telemetry_raw_'||event_type AS topic, 'u'||(user_id%3) AS source_session, strftime(make_timestamp(epoch_us(ts)//200),'%Y-%m-%d') AS event_date, strftime(make_timestamp(epoch_us(ts)//200),'%H') AS event_hour,
    count(*) AS n, min(epoch_us(ts)//200) AS first_us FROM events GROUP BY ALL""",
)
def st12(spark, sf):
    """Two hundredfold time and three sessions, so that an hour of a session holds many records, as recorded traffic does."""
    e = event_stream(spark, sf)
    iso = F.date_format(F.timestamp_micros(F.floor(epoch_us(F.col("ts")) / 200)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    payload = F.to_json(F.struct(F.lit("d").alias("device_id"), F.concat(F.lit("u"), F.col("user_id") % 3).alias("source_session"), iso.alias("captured_at"), "value"))
    rows = e.select(F.concat(F.lit("telemetry/raw "), "event_type").alias("topic"), F.create_map(F.lit("a"), F.col("event_type")).alias("headers"),
                    payload.alias("payload_json"), F.lit(1_710_000_000_000_000).alias("archived_us"))
    folder = work_dir(spark)
    archive.archive_stream(archive.normalise(rows), f"{folder}/out", f"{folder}/log", available_now=True).awaitTermination()
    kinds = ", ".join(f"{c} string" for c in archive.PARTITIONS)
    out = spark.read.schema(f"event_us long, {kinds}").parquet(f"{folder}/out")
    return out.groupBy(*archive.PARTITIONS).agg(F.count("*").alias("n"), F.min("event_us").alias("first_us"))


@query(
    "st14_upsert_stream",
    "SELECT 'u'||user_id AS session, event_type AS kind, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) FILTER (WHERE event_id%5=0) AS length_m FROM events GROUP BY 1, 2",
)
def st14(spark, sf):
    rows = event_stream(spark, sf).select(
        F.concat(F.lit("u"), "user_id").alias("session"), F.col("event_type").alias("kind"), "event_id", F.when(F.col("event_id") % 5 == 0, F.col("value")).alias("length_m"))
    folder = work_dir(spark)
    writer = upsert.upsert_stream(rows, f"{folder}/out", f"{folder}/log", ["session", "kind"], ["event_id"], "kind", keep_known=("length_m",))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("session", "kind", "event_id", "length_m")


@query(
    "st2_lap_stream",
    f"""{_LAP_SQL}, done AS (SELECT * FROM cr WHERE t1 IS NOT NULL), agg AS (SELECT d.session_key, d.epoch, d.lap, d.t0, d.t1, sum(step) AS dist, count(*) AS n FROM done d JOIN mv ON mv.session_key=d.session_key AND mv.epoch=d.epoch AND mv.t>d.t0 AND mv.t<=d.t1 GROUP BY ALL)
    SELECT session_key, CAST(epoch AS BIGINT) AS epoch, CAST(lap AS BIGINT) AS lap_number, t0 AS lap_start_ms, t1 AS lap_end_ms, floor(dist*10+0.5e0)/10 AS distance_m, n + CASE WHEN lap=1 THEN 1 ELSE 0 END AS gps_point_count FROM agg""",
)
def st2s(spark, sf):
    records = driving.lap_records(event_stream(spark, sf).withColumnRenamed("t_us", "arrived_us"), "arrived_us")
    return run_to_table(laps.laps_stream(records, Profile())).select("session_key", "epoch", "lap_number", "lap_start_ms", "lap_end_ms", "distance_m", "gps_point_count")


EPOCH = 1_700_000_000_000_000


CATCH_UP_US = 5_000_000_000


def _arrived(key, base):
    """Device d1 uploads everything five thousand seconds late; the others at once."""
    return base + F.when(key % 3 == 1, CATCH_UP_US).otherwise(200_000)


def _frame_records(spark, sf):
    """Receipts from the orders and samples from their lines, receipts three seconds behind, and a last tick."""
    k, ln = F.col("o_orderkey"), F.col("l_orderkey")
    kinds = F.when(F.col("l_linenumber") == 1, "gps").when(F.col("l_linenumber") == 2, "imu").when(F.col("l_linenumber") == 4, "unknown").when(F.col("l_linenumber") == 5, "discovery").otherwise("can")
    none = F.lit(None).cast("long")
    base, line_base = k * 1_000_000 + EPOCH, ln * 1_000_000 + EPOCH
    receipts = table(spark, sf, "orders").where(k % 13 != 0).select(
        F.concat(F.lit("c"), k % 50).alias("session"), F.concat(F.lit("d"), k % 3).alias("device"), base.alias("base_us"), (_arrived(k, base) + 3_000_000).alias("arrived_us"), F.lit("session").alias("kind"),
        F.lit(1).cast("long").alias("sent_gps"), (k % 3).alias("sent_imu"), (k % 4 + 1).alias("sent_can"))
    samples = table(spark, sf, "lineitem").select(
        F.concat(F.lit("c"), ln % 50).alias("session"), F.concat(F.lit("d"), ln % 3).alias("device"), line_base.alias("base_us"), _arrived(ln, line_base).alias("arrived_us"), kinds.alias("kind"),
        none.alias("sent_gps"), none.alias("sent_imu"), none.alias("sent_can"))
    records = receipts.unionByName(samples)
    tick = records.agg((F.max("arrived_us") + 100_000_000).alias("arrived_us")).select(
        F.lit("clock").alias("session"), F.lit("clock").alias("device"), F.lit(0).cast("long").alias("base_us"), "arrived_us", F.lit("tick").alias("kind"), none.alias("sent_gps"), none.alias("sent_imu"), none.alias("sent_can"))
    return records.unionByName(tick)


_FRAMES = """WITH s AS (SELECT l_orderkey AS k, count(*) FILTER (WHERE l_linenumber=1) AS g, count(*) FILTER (WHERE l_linenumber=2) AS i, count(*) FILTER (WHERE l_linenumber>2) AS n FROM lineitem GROUP BY 1),
    r AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey%13<>0), a AS (SELECT coalesce(s.k, r.k) AS k, coalesce(g,0) AS g, coalesce(i,0) AS i, coalesce(n,0) AS n, r.k IS NOT NULL AS rec, s.k IS NOT NULL AS has FROM s FULL JOIN r ON s.k=r.k),
    f AS (SELECT k*1000000+1700000000000000 AS base_us, CASE WHEN rec AND g=1 AND i=k%3 AND n=k%4+1 THEN 'complete' WHEN has THEN 'incomplete' ELSE 'empty' END AS status FROM a)"""
_LAST = "(SELECT greatest((SELECT max(l_orderkey) FROM lineitem), (SELECT max(o_orderkey) FROM orders WHERE o_orderkey%13<>0))*1000000+1700000000000000)"


@query("st4_frame_assembly", _FRAMES + " SELECT base_us, status FROM f")
def st4(spark, sf):
    return run_to_table(frames.assemble(replayed(_frame_records(spark, sf), "arrived_us"))).select("base_us", "status")


@query("st4_frame_windows", _FRAMES + f" SELECT base_us, status FROM f WHERE base_us + 1000000 <= {_LAST} - 30000000")
def st4w(spark, sf):
    timely = _frame_records(spark, sf).where("kind <> 'tick'")
    return run_to_table(frames.assemble_windowed(replayed(timely, "base_us"))).select("base_us", "status")


def session_traffic(rows):
    kind = F.when(F.col("signal") == "signup", "session_end").when(F.col("signal") == "view", "can").otherwise("gps")
    return rows.select("session", "device", "event_id", F.floor(F.col("t_us") / 100).alias("t_us"), kind.alias("kind"))


_TRAFFIC = """WITH t AS (SELECT session, device, event_id, t_us//100 AS t, CASE signal WHEN 'signup' THEN 'session_end' WHEN 'view' THEN 'can' ELSE 'gps' END AS kind FROM v_signal),
    e AS (SELECT *, max(CASE WHEN kind='session_end' THEN 1 ELSE 0 END) OVER (PARTITION BY session, device ORDER BY t, event_id) AS ended FROM t),
    l AS (SELECT *, lag(t) OVER w AS pt, lag(ended) OVER w AS pe FROM e WINDOW w AS (PARTITION BY session, device ORDER BY t, event_id)),
    r AS (SELECT *, sum(CASE WHEN t-pt >= CASE WHEN pe=1 THEN 120000000 ELSE 1800000000 END THEN 1 ELSE 0 END) OVER (PARTITION BY session, device ORDER BY t, event_id) AS run FROM l)"""


_CLOSED = _TRAFFIC + """ SELECT session, device, min(t) FILTER (WHERE run=0) AS first_us, max(t) FILTER (WHERE run=0) AS last_us, count(*) FILTER (WHERE run=0 AND kind='can') AS can_frames, count(*) FILTER (WHERE run=0) AS records,
    max(ended) FILTER (WHERE run=0)=1 AS ended, count(*) FILTER (WHERE run>0) AS late FROM r GROUP BY 1, 2"""


@query("st6_session_close", _CLOSED, ("v_signal",))
def st6(spark, sf):
    return sessions.close_batch(session_traffic(views.v_signal(spark, sf)), ["t_us", "event_id"], 864_000_000)


@query("st6_session_close_stream", _CLOSED, ("v_signal",))
def st6s(spark, sf):
    """Every third device uploads an hour of its clock late; a last tick lets the clock run out."""
    t = session_traffic(views.v_signal(spark, sf)).withColumnRenamed("event_id", "seq")
    late = F.when(F.substring("device", 2, 1).cast("int") % 3 == 1, 3_600_000_000).otherwise(0)
    records = t.withColumn("arrived_us", F.col("t_us") + late)
    tick = records.agg((F.max("arrived_us") + 4_000_000_000).alias("arrived_us"))
    tick = tick.select(F.lit("clock").alias("session"), F.lit("clock").alias("device"), F.lit(0).cast("long").alias("seq"), F.lit(0).cast("long").alias("t_us"), F.lit(sessions.TICK).alias("kind"), "arrived_us")
    return sessions.totals(run_to_table(sessions.close_stream(replayed(records.unionByName(tick), "arrived_us"))))


def with_tick(rows, clock, ahead_us):
    """The rows and a last one, empty but for its `clock`, that lets time run on."""
    last = rows.agg((F.max(clock) + ahead_us).alias(clock))
    return rows.unionByName(last, allowMissingColumns=True)


def _waiting_records(spark, sf):
    """Frames of 150 sessions, each seventeenth twice; a session's row comes in up to ten versions, for a quarter of them never."""
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    base = k * 1_000_000 + EPOCH
    status = F.when(k % 11 == 0, "empty").when(k % 5 == 0, "incomplete").otherwise("complete")
    once = table(spark, sf, "orders").select(
        F.concat(F.lit("c"), k % 50).alias("session"), F.concat(F.lit("d"), k % 3).alias("device"), F.lit("frame").alias("kind"), _arrived(k, base).alias("arrived_us"), base.alias("base_us"), status.alias("status"))
    again = once.where((F.col("base_us") - EPOCH) / 1_000_000 % 17 == 0).withColumn("arrived_us", F.col("arrived_us") + 700_000_000)
    rows = table(spark, sf, "customer").where(c % 200 % 4 != 0).select(
        F.concat(F.lit("c"), c % 50).alias("session"), F.concat(F.lit("d"), c % 3).alias("device"), F.lit("dimension").alias("kind"), (c * 40_000_000 + EPOCH).alias("arrived_us"),
        c.alias("vehicle_id"), F.concat(F.lit("acct"), c % 7).alias("user_sub"))
    return with_tick(once.unionByName(again).unionByName(rows, allowMissingColumns=True), "arrived_us", 100_000_000)


@query(
    "st5_dimension_wait",
    """WITH f AS (SELECT o_orderkey AS k, o_orderkey*1000000+1700000000000000 AS base_us, o_orderkey*1000000+1700000000000000+CASE WHEN o_orderkey%3=1 THEN 5000000000 ELSE 200000 END AS came,
        CASE WHEN o_orderkey%11=0 THEN 'empty' WHEN o_orderkey%5=0 THEN 'incomplete' ELSE 'complete' END AS status FROM orders),
    d AS (SELECT c_custkey%50 AS s, c_custkey%3 AS v, c_custkey*40000000+1700000000000000 AS came, c_custkey AS vehicle_id FROM customer WHERE c_custkey%200%4<>0),
    fd AS (SELECT s, v, min(came) AS came FROM d GROUP BY 1, 2),
    w AS (SELECT f.*, fd.came AS known, CASE WHEN status='empty' THEN 'empty' WHEN fd.came <= f.came+30000000 THEN 'known' ELSE 'unknown' END AS outcome FROM f LEFT JOIN fd ON fd.s=f.k%50 AND fd.v=f.k%3),
    m AS (SELECT w.k, max(d.vehicle_id) AS vehicle_id FROM w JOIN d ON d.s=w.k%50 AND d.v=w.k%3 AND d.came <= greatest(w.came, w.known) WHERE outcome='known' GROUP BY 1)
    SELECT 'c'||(k%50) AS session, 'd'||(k%3) AS device, base_us, status, outcome, vehicle_id, 'acct'||(vehicle_id%7) AS user_sub FROM w LEFT JOIN m USING (k)
    UNION ALL SELECT 'c'||(k%50), 'd'||(k%3), base_us, status, CASE WHEN status='empty' THEN 'empty' ELSE 'replayed' END, NULL, NULL FROM f WHERE k%17=0""",
)
def st5(spark, sf):
    return run_to_table(dimension.wait_for_dimension(replayed(_waiting_records(spark, sf), "arrived_us")))


AS_LONG_MS = 100 * 86_400_000  # as long as the tables last: sessions pause for days there


@query(
    "st_carry_restored",
    drives._CARRY + f""" SELECT session, device, start_us, signal, {s4('v')} AS value, CASE WHEN seen<start_us THEN (start_us+10800000000-seen)//1000 END AS age_ms FROM held""",
    ("v_signal",),
)
def carried(spark, sf):
    """Stopped half way: a second stream without the first one's checkpoint goes on from the table that the first wrote."""
    frames_dir = f"{work_dir(spark)}/frames"
    closed = carry.frame_arrays(drives.can_samples(spark, sf)).withColumn("arrived_us", F.col("base_us") + drives.SIX)
    closed.write.parquet(frames_dir)  # read by both halves
    closed = spark.read.schema(closed.schema).parquet(frames_dir)
    edge = views.v_signal(spark, sf).agg(((F.min("t_us") + F.max("t_us")) / 2).cast("long").alias("half")).first()
    half = F.lit(edge["half"] or 0)

    def ran(rows, written=None):
        return run_to_table(carry.carry_stream(replayed(rows, "arrived_us", 3), 3 * drives.HOUR, drives.SIX, written, forget_ms=AS_LONG_MS))

    before = ran(closed.where(F.col("base_us") < half))
    rows = before.unionByName(ran(closed.where(F.col("base_us") >= half), before))
    flat = rows.where("NOT late").select("session", "device", "start_us", "carried", F.explode("signals").alias("signal", "value"))
    return flat.select("session", "device", "start_us", "signal", q4(F.col("value")).alias("value"), F.try_element_at("carried", F.col("signal")).alias("age_ms"))


WITHIN_US = 10_800_000_000


@query(
    "st_rate_check",
    f"WITH RECURSIVE {signals._RATED_SQL} SELECT event_id, session, signal, coalesce(reason, 'ok') AS reason FROM verdict",
    ("v_signal",),
)
def rated(spark, sf):
    """Every sample comes up to three hours after its time, so neighbours arrive in any order."""
    rows = views.v_signal(spark, sf).select("session", "signal", F.col("event_id").alias("seq"), "t_us", "value", (F.col("t_us") + F.col("event_id") * 7919 % 10_801 * 1_000_000).alias("arrived_us"))
    ticked = with_tick(rows, "arrived_us", 2 * WITHIN_US).withColumn("t_us", F.coalesce("t_us", "arrived_us"))
    out = run_to_table(rates.rate_check_stream(replayed(ticked, "arrived_us"), signals.RANGES, signals.DELTAS, WITHIN_US, forget_ms=AS_LONG_MS))
    return out.select(F.col("seq").alias("event_id"), "session", "signal", F.coalesce("reason", F.lit("ok")).alias("reason"))


def _routed_stream(spark, sf):
    rows = with_tick(views.v_signal(spark, sf), "t_us", 3 * 86_400_000_000)
    return route(replayed(rows, "t_us").withColumn("unit", F.lit("u")), signals.RULES).where("topic IS NOT NULL OR signal IS NULL")


@query("st_a1_windows", f"WITH {signals._STATS_SQL} SELECT {signals._STAT_SQL_COLUMNS}, reason FROM judged", ("v_signal",))
def a1s(spark, sf):
    return run_to_table(windows.window_stream(_routed_stream(spark, sf), signals.WINDOWS)).select(*signals._stat_columns(), "reason")


@query("st_a3_derived", f"WITH {signals._DERIVED_SQL} SELECT {signals._STAT_SQL_COLUMNS} FROM derived", ("v_signal",))
def a3s(spark, sf):
    return run_to_table(windows.derived_stream(_routed_stream(spark, sf), signals.WINDOWS)).select(*signals._stat_columns())


@query(
    "st_a8_rollup",
    f"WITH {drives._ROLL} SELECT session, device, user_sub, mode, vehicle_id, track_id, started_us, ended_us, end_reason, frames_expected, frames_received, duplicates, last_frame_received_us FROM ses",
)
def a8s(spark, sf):
    """Messages in the order of arrival over six micro-batches, each upserted into the table of sessions."""
    folder, records = work_dir(spark), drives.session_records(spark, sf).withColumn("arrival", F.col("arrival") + EPOCH)
    with large_state(spark):
        writer = upsert.upsert_stream(rollup.roll_up_stream(replayed(records, "arrival")), f"{folder}/out", f"{folder}/log", S.KEYS, ["version"], "device", guard="version")
        writer.outputMode("update").trigger(availableNow=True).start().awaitTermination()
    tracks = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("track_id"))
    out = S.known_tracks(spark.read.parquet(f"{folder}/out"), tracks)
    return out.select(*S.KEYS, "user_sub", *S.START_FIELDS, "ended_us", "end_reason", "frames_expected", "frames_received", "duplicates", "last_frame_received_us")


def _decoded_stream(spark, sf):
    folder = work_dir(spark)
    dimensions = decode.Dimensions(*[(lambda session, k=k: decoding.dimensions(session, sf)[k]) for k in range(3)], lambda session: session.createDataFrame(decoding.DBC_ROWS, decoding._DBC_SCHEMA))
    decode.decode_stream(replayed(decoding.raw_frames(spark, sf), "t_us"), dimensions, folder, f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    return folder


@query(
    "st_c1_decode",
    f"""WITH {decoding._DECODE_SQL} SELECT session, dbc, can_id, signal, count(*) AS n, {s4("sum(CASE WHEN signal='Whole' THEN value/1e15 ELSE value END)")} AS total FROM dec GROUP BY ALL""",
    ("v_can",),
)
def decoded(spark, sf):
    rows = spark.read.parquet(f"{_decoded_stream(spark, sf)}/{decode.SIGNALS}")
    value = F.when(F.col("signal") == "Whole", F.col("value") / 1e15).otherwise(F.col("value"))
    return rows.groupBy("session", "dbc", "can_id", "signal").agg(F.count("*").alias("n"), q4(F.sum(value)).alias("total"))


@query(
    "st_c3_outcomes",
    f"""WITH {decoding._RESOLVED_SQL} SELECT session, CASE WHEN data_hex='zz' THEN 'unreadable' WHEN no_dbc='session not found' THEN 'dropped' WHEN no_dbc IS NOT NULL THEN 'discovery'
      WHEN need IS NULL OR nb<need THEN 'unknown' ELSE 'decoded' END AS outcome,
      CASE WHEN data_hex='zz' THEN NULL WHEN no_dbc IS NOT NULL THEN no_dbc WHEN need IS NULL THEN 'no_dbc_message' WHEN nb<need THEN 'layout_mismatch' END AS reason,
      count(*) AS n FROM outc GROUP BY ALL""",
    ("v_can",),
)
def outcomes(spark, sf):
    return spark.read.parquet(f"{_decoded_stream(spark, sf)}/{decode.OUTCOMES}").groupBy("session", "outcome", "reason").agg(F.count("*").alias("n"))
