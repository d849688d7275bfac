"""Queries over signal events: profile decode, validation, routing, windows, sinks, average speed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.operators.ordered import DAY_US
from roadlake.operators.profile import decode_profile, frame_fault, signal_events, with_probe
from roadlake.operators.route import Rule, route
from roadlake.operators.speed import average_speed
from roadlake.operators.validate import compare_summaries, drop_events, row_reason, validate
from roadlake.operators.windows import Derived, WindowConfig, aggregate, derive, window_stats
from roadlake.plans.registry import q4, query, s4
from roadlake.plans.replay import out_of_order, replay_log
from roadlake.plans.views import spread_table, table, v_signal
from roadlake.sources.sinks import record_counts, sink_records

RANGES = {"view": (1.0, 150.0), "click": (0.5, 100.0)}
DELTAS = {"view": 60.0, "click": 40.0, "error": 80.0, "signup": 30.0}
RULES = (
    Rule("r-interest", ("c*", "?iew"), ("signals.interest", "signals.all")),
    Rule("r-money", ("purch[ae]se",), ("signals.money",)),
    Rule("r-all", ("[!e]*",), ("signals.all",)),
)
WINDOWS = WindowConfig(
    default_seconds=21_600,
    seconds={"click": 86_400},
    min_samples={"view": 3},
    max_samples={"purchase": 18},
    derived=(Derived("interest", "signals.all", ("view", "signup"), "v*s", "view * signup"),),
)

# ---- profile frames: the lineitem rows dressed as the profile's messages, some broken, some probes ----

_FRAMES_SQL = """
  raw AS (SELECT session, device, t_us, seq, can_id - 512 AS ln, data_hex,
      CAST(('0x'||substr(data_hex,1,4)) AS BIGINT) AS p, CAST(('0x'||substr(data_hex,5,4)) AS BIGINT) AS s FROM v_can),
  f AS (SELECT session, device, seq, ln, p, s,
      CASE WHEN p % 401 = 0 THEN -5 ELSE t_us // 1000 END AS timestamp_ms,
      CASE ln WHEN 1 THEN 201 WHEN 2 THEN 1001 WHEN 3 THEN 1217 WHEN 4 THEN 1233 WHEN 5 THEN 495 WHEN 6 THEN 309
        ELSE CASE WHEN s % 2 = 0 THEN 2047 ELSE 291 END END AS can_id,
      CASE WHEN (t_us // 1000000) % 5 = 0 THEN 8 - p % 8 ELSE 8 END AS dlc,
      CASE WHEN ln = 7 THEN 'ca'||substr(data_hex,1,8)||substr(data_hex,11,2)||printf('%02x', p % 2)||'00' ELSE data_hex END AS data_hex
      FROM raw)"""


def profile_frames(spark: SparkSession, sf: str) -> DataFrame:
    line = spread_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], ["l_orderkey"])
    ln = F.col("l_linenumber").cast("long")
    p, s = F.col("l_partkey") % 65536, F.col("l_suppkey") % 65536

    def hex_of(value, digits):
        return F.lpad(F.lower(F.hex(value)), digits, "0")

    head = F.concat(hex_of(p, 4), hex_of(s, 4))
    quantity = hex_of(F.round(F.col("l_quantity") * 100).cast("long") % 65536, 4)
    probe = F.concat(F.lit("ca"), head, F.substring(quantity, 3, 2), F.lit("0"), (p % 2).cast("string"), F.lit("00"))
    ids = F.array(*[F.lit(i).cast("long") for i in (0x0C9, 0x3E9, 0x4C1, 0x4D1, 0x1EF, 0x135)])
    return line.select(
        F.concat(F.lit("s"), F.col("l_orderkey") % 97).alias("session"),
        F.concat(F.lit("d"), F.col("l_orderkey") % 10).alias("device"),
        (F.col("l_extendedprice") * 100).cast("long").alias("event_id"),
        F.when(p % 401 == 0, F.lit(-5)).otherwise(F.col("l_orderkey") * 1000 + ln * 20).cast("long").alias("timestamp_ms"),
        F.when(ln < 7, F.try_element_at(ids, ln.cast("int"))).when(s % 2 == 0, 0x7FF).otherwise(0x123).cast("long").alias("can_id"),
        F.when(F.col("l_orderkey") % 5 == 0, F.lit(8) - p % 8).otherwise(F.lit(8)).cast("int").alias("dlc"),
        F.when(ln == 7, probe).otherwise(F.concat(head, quantity, hex_of(ln, 4))).alias("data_hex"),
    )


_DECODED_SQL = _FRAMES_SQL + """,
  g AS (SELECT *, CASE WHEN timestamp_ms < 0 THEN 'FRAME_INVALID'
      WHEN can_id = 2047 AND dlc = 8 THEN NULL
      WHEN can_id IN (291, 2047) THEN 'UNKNOWN_CAN_ID'
      WHEN dlc < CASE can_id WHEN 201 THEN 6 WHEN 1001 THEN 2 WHEN 1217 THEN 5 WHEN 1233 THEN 3 WHEN 495 THEN 4 ELSE 1 END
      THEN 'DBC_DECODE_FAILED' END AS reason,
      CAST('0x'||substr(data_hex,1,2) AS BIGINT) AS b0, CAST('0x'||substr(data_hex,3,2) AS BIGINT) AS b1,
      CAST('0x'||substr(data_hex,5,2) AS BIGINT) AS b2, CAST('0x'||substr(data_hex,7,2) AS BIGINT) AS b3,
      CAST('0x'||substr(data_hex,9,2) AS BIGINT) AS b4, CAST('0x'||substr(data_hex,11,2) AS BIGINT) AS b5 FROM f),
  sig AS (
      SELECT *, 'EngineRPM' AS signal, (b1*256+b2)*0.25e0 AS value FROM g WHERE can_id = 201
      UNION ALL SELECT *, 'ThrottlePosition', b4/2.55e0 FROM g WHERE can_id = 201
      UNION ALL SELECT *, 'BrakePedalApplied', CAST(b5 & 1 AS DOUBLE) FROM g WHERE can_id = 201
      UNION ALL SELECT *, 'VehicleSpeed', (b0*256+b1)*0.01e0 FROM g WHERE can_id = 1001
      UNION ALL SELECT *, 'CoolantTemp', CAST(b2-40 AS DOUBLE) FROM g WHERE can_id = 1217
      UNION ALL SELECT *, 'IntakeAirTemp', CAST(b3-40 AS DOUBLE) FROM g WHERE can_id = 1217
      UNION ALL SELECT *, 'AmbientTemp', b4/2.0e0-40 FROM g WHERE can_id = 1217
      UNION ALL SELECT *, 'EngineOilTemp', CAST(b2-40 AS DOUBLE) FROM g WHERE can_id = 1233
      UNION ALL SELECT *, 'MassAirFlow', (b2*256+b3)/100.0e0 FROM g WHERE can_id = 495
      UNION ALL SELECT *, 'TransmissionGear', CAST(b0 AS DOUBLE) FROM g WHERE can_id = 309
      UNION ALL SELECT *, 'ProbeFrame', 1.0e0 FROM g WHERE can_id = 2047 AND dlc = 8),
  ev AS (SELECT * FROM sig WHERE reason IS NULL)"""


@query(
    "c4_profile_decode",
    f"""WITH {_DECODED_SQL}
    SELECT session, signal, count(*) AS n, {s4('sum(value)')} AS total, {s4('min(value)')} AS low, {s4('max(value)')} AS high
    FROM ev GROUP BY session, signal""",
    ("v_can",),
)
def c4(spark, sf):
    ev = signal_events(decode_profile(profile_frames(spark, sf)))
    return ev.groupBy("session", "signal").agg(
        F.count("*").alias("n"), q4(F.sum("value")).alias("total"), q4(F.min("value")).alias("low"), q4(F.max("value")).alias("high")
    )


@query(
    "c5_probe_detect",
    f"""WITH {_FRAMES_SQL}
    SELECT session, timestamp_ms, lower(substr(data_hex,3,8)) AS tracer_id, CAST(CAST('0x'||substr(data_hex,11,2) AS BIGINT) AS BIGINT) AS flow_id,
      (CAST('0x'||substr(data_hex,13,2) AS BIGINT) & 1) = 1 AS suppress_egress
    FROM f WHERE can_id = 2047 AND dlc = 8 AND substr(data_hex,1,2) = 'ca'""",
    ("v_can",),
)
def c5(spark, sf):
    return with_probe(profile_frames(spark, sf)).where("probe IS NOT NULL").select(
        "session", "timestamp_ms", "probe.tracer_id", F.col("probe.flow_id").cast("long").alias("flow_id"), "probe.suppress_egress"
    )


@query(
    "v4_frame_validity",
    f"""WITH {_FRAMES_SQL}
    SELECT session, CASE WHEN timestamp_ms < 0 THEN 'FRAME_INVALID' ELSE 'ok' END AS verdict, count(*) AS n,
    CAST(sum(dlc) AS BIGINT) AS bytes FROM f GROUP BY 1, 2""",
    ("v_can",),
)
def v4(spark, sf):
    frames = profile_frames(spark, sf)
    return frames.groupBy("session", F.coalesce(frame_fault(frames), F.lit("ok")).alias("verdict")).agg(
        F.count("*").alias("n"), F.sum("dlc").cast("long").alias("bytes")
    )


@query(
    "v1_filter_glob",
    """SELECT signal, CASE WHEN signal GLOB 'p*' OR signal GLOB '?iew' THEN 'FILTER_REJECTED' ELSE 'ok' END AS reason,
    count(*) AS n FROM v_signal GROUP BY 1, 2""",
    ("v_signal",),
)
def v1(spark, sf):
    reason = F.coalesce(row_reason({}, ("p*", "?iew")), F.lit("ok"))
    return v_signal(spark, sf).groupBy("signal", reason.alias("reason")).agg(F.count("*").alias("n"))


@query(
    "v2_range_check",
    """SELECT session, signal, count(*) FILTER (WHERE bad) AS refused, count(*) FILTER (WHERE NOT bad) AS kept FROM (
      SELECT *, (signal='view' AND NOT value BETWEEN 1.0e0 AND 150.0e0) OR (signal='click' AND NOT value BETWEEN 0.5e0 AND 100.0e0) AS bad
      FROM v_signal) GROUP BY 1, 2""",
    ("v_signal",),
)
def v2(spark, sf):
    out = row_reason(RANGES).isNotNull()
    return v_signal(spark, sf).groupBy("session", "signal").agg(
        F.count_if(out).alias("refused"), F.count_if(~out).alias("kept")
    )


_RATED_SQL = """
  fit AS (SELECT *, (signal='view' AND NOT value BETWEEN 1.0e0 AND 150.0e0) OR (signal='click' AND NOT value BETWEEN 0.5e0 AND 100.0e0) AS bad FROM v_signal),
  seq AS (SELECT *, row_number() OVER (PARTITION BY session, signal ORDER BY t_us, event_id) AS n,
      CASE signal WHEN 'view' THEN 60.0e0 WHEN 'click' THEN 40.0e0 WHEN 'error' THEN 80.0e0 WHEN 'signup' THEN 30.0e0 END AS lim
      FROM fit WHERE NOT bad),
  fold AS (
      SELECT session, signal, event_id, n, value AS held, true AS ok FROM seq WHERE n = 1 AND lim IS NOT NULL
      UNION ALL
      SELECT s.session, s.signal, s.event_id, s.n, CASE WHEN abs(s.value - f.held) <= s.lim THEN s.value ELSE f.held END,
             abs(s.value - f.held) <= s.lim
      FROM fold f JOIN seq s ON s.session = f.session AND s.signal = f.signal AND s.n = f.n + 1),
  verdict AS (SELECT v.*, CASE WHEN v.bad THEN 'RANGE_EXCEEDED' WHEN NOT coalesce(d.ok, true) THEN 'RATE_IMPLAUSIBLE' END AS reason
      FROM fit v LEFT JOIN fold d USING (event_id))"""


@query(
    "v3_rate_check",
    f"WITH RECURSIVE {_RATED_SQL} SELECT event_id, session, signal, coalesce(reason, 'ok') AS reason FROM verdict",
    ("v_signal",),
)
def v3(spark, sf):
    checked = validate(v_signal(spark, sf), RANGES, DELTAS, chunk=15 * DAY_US)
    return checked.select("event_id", "session", "signal", F.coalesce("reason", F.lit("ok")).alias("reason"))


@query(
    "v5_drop_sampling",
    f"""WITH {_DECODED_SQL}, r AS (SELECT *, CASE WHEN signal = 'ProbeFrame' OR value > 100 THEN 'RANGE_EXCEEDED' END AS drop_reason FROM ev)
    SELECT tracer_id, hop, outcome, reason, signal, t_us, count(*) AS n FROM (
      SELECT CASE WHEN signal = 'ProbeFrame' THEN lower(substr(data_hex,3,8)) END AS tracer_id, 'validate' AS hop, 'dropped' AS outcome,
      drop_reason AS reason, signal, timestamp_ms * 1000 AS t_us FROM r
      WHERE drop_reason IS NOT NULL AND (signal = 'ProbeFrame' OR (timestamp_ms // 1000) % 10 = 0)) GROUP BY ALL""",
    ("v_can",),
)
def v5(spark, sf):
    ev = signal_events(decode_profile(profile_frames(spark, sf))).withColumn("t_us", F.col("timestamp_ms") * 1000)
    rejected = ev.withColumn("reason", F.when((F.col("signal") == "ProbeFrame") | (F.col("value") > 100), "RANGE_EXCEEDED"))
    drops = drop_events(rejected, "validate", F.floor(F.col("timestamp_ms") / 1000) % 10 == 0)
    return drops.groupBy(*drops.columns).agg(F.count("*").alias("n"))


_ROUTED_SQL = """
  targets AS (SELECT * FROM (VALUES ('r-interest', 'signals.interest'), ('r-interest', 'signals.all'), ('r-money', 'signals.money'),
      ('r-all', 'signals.all')) t(rule_id, topic)),
  routed AS (SELECT s.*, t.rule_id, t.topic, 'u' AS unit FROM v_signal s JOIN targets t ON CASE t.rule_id
      WHEN 'r-interest' THEN s.signal GLOB 'c*' OR s.signal GLOB '?iew' WHEN 'r-money' THEN s.signal IN ('purchase', 'purchese')
      ELSE s.signal NOT LIKE 'e%' END)"""


def _routed(spark, sf):
    return route(v_signal(spark, sf).withColumn("unit", F.lit("u")), RULES)


@query(
    "j4_glob_route",
    f"""WITH {_ROUTED_SQL}
    SELECT signal, topic, rule_id, NULL AS reason, count(*) AS n FROM routed GROUP BY 1, 2, 3
    UNION ALL SELECT signal, NULL, NULL, 'NO_ROUTE', count(*) FROM v_signal
    WHERE event_id NOT IN (SELECT event_id FROM routed) GROUP BY 1""".replace("NULL AS reason", "CAST(NULL AS VARCHAR) AS reason"),
    ("v_signal",),
)
def j4(spark, sf):
    return _routed(spark, sf).groupBy("signal", "topic", "rule_id", F.col("route_reason").alias("reason")).agg(F.count("*").alias("n"))


_STATS_SQL = _ROUTED_SQL + """,
  win AS (SELECT topic, signal, start, start + len AS stop, arg_min(unit, (t_us, event_id)) AS unit, arg_min(session, (t_us, event_id)) AS session,
      count(*) AS n, min(value) AS lo, max(value) AS hi, avg(value) AS mean, stddev_pop(value) AS sd
      FROM (SELECT *, CASE signal WHEN 'click' THEN 86400000000 ELSE 21600000000 END AS len,
            t_us - t_us % (CASE signal WHEN 'click' THEN 86400000000 ELSE 21600000000 END) AS start FROM routed) GROUP BY topic, signal, start, len),
  judged AS (SELECT *, CASE WHEN signal = 'purchase' AND n > 18 THEN 'WINDOW_OVERFLOW' WHEN signal = 'view' AND n < 3 THEN 'INSUFFICIENT_SAMPLES' END AS reason FROM win)"""


def _stat_columns():
    return ["topic", "signal", "unit", "session", "window_start_us", "window_end_us", "sample_count",
            *[q4(F.col(c)).alias(c) for c in ("min_value", "max_value", "mean_value", "stddev_value")]]


_STAT_SQL_COLUMNS = f"""topic, signal, unit, session, CAST(start AS BIGINT) AS window_start_us, CAST(stop AS BIGINT) AS window_end_us, n AS sample_count,
    {s4('lo')} AS min_value, {s4('hi')} AS max_value, {s4('mean')} AS mean_value, {s4('sd')} AS stddev_value"""


@query("a1_window_stats", f"WITH {_STATS_SQL} SELECT {_STAT_SQL_COLUMNS} FROM judged", ("v_signal",))
def a1(spark, sf):
    return window_stats(_routed(spark, sf).where("topic IS NOT NULL"), WINDOWS).select(*_stat_columns())


@query(
    "a2_window_guards",
    f"WITH {_STATS_SQL} SELECT topic, signal, coalesce(reason, 'ok') AS reason, count(*) AS windows, CAST(sum(n) AS BIGINT) AS samples FROM judged GROUP BY 1, 2, 3",
    ("v_signal",),
)
def a2(spark, sf):
    stats = window_stats(_routed(spark, sf).where("topic IS NOT NULL"), WINDOWS)
    return stats.groupBy("topic", "signal", F.coalesce("reason", F.lit("ok")).alias("reason")).agg(
        F.count("*").alias("windows"), F.sum("sample_count").alias("samples")
    )


_DERIVED_SQL = _STATS_SQL + """,
  derived AS (SELECT a.topic, 'interest' AS signal, 'v*s' AS unit, a.session, a.start, a.stop, least(a.n, b.n) AS n,
      a.mean * b.mean AS lo, a.mean * b.mean AS hi, a.mean * b.mean AS mean, 0.0e0 AS sd
      FROM judged a JOIN judged b ON a.topic = b.topic AND a.start = b.start AND a.stop = b.stop
      WHERE a.topic = 'signals.all' AND a.signal = 'view' AND b.signal = 'signup' AND a.reason IS NULL AND b.reason IS NULL)"""


@query("a3_derived_signals", f"WITH {_DERIVED_SQL} SELECT {_STAT_SQL_COLUMNS} FROM derived", ("v_signal",))
def a3(spark, sf):
    stats = window_stats(_routed(spark, sf).where("topic IS NOT NULL"), WINDOWS).where("reason IS NULL")
    return derive(stats, WINDOWS.derived).select(*_stat_columns())


@query(
    "a4_probe_passthrough",
    f"""WITH {_DECODED_SQL}, r AS (SELECT *, 'signals.' || CASE WHEN signal = 'ProbeFrame' THEN 'probe' ELSE 'x' END AS topic FROM ev),
    win AS (SELECT topic, signal, timestamp_ms*1000 - (timestamp_ms*1000) % 3600000000 AS a, count(*) AS n, avg(value) AS m FROM r
      WHERE signal <> 'ProbeFrame' GROUP BY ALL)
    SELECT kind, topic, signal, window_start_us, window_end_us, sample_count, mean_value, count(*) AS copies FROM (
      SELECT 'WINDOWED' AS kind, topic, signal, a AS window_start_us, a + 3600000000 AS window_end_us, n AS sample_count, {s4('m')} AS mean_value FROM win
      UNION ALL SELECT 'PROBE_PASSTHROUGH', topic, signal, timestamp_ms*1000, timestamp_ms*1000, 1, 1.0e0 FROM r WHERE signal = 'ProbeFrame')
    GROUP BY ALL""",
    ("v_can",),
)
def a4(spark, sf):
    ev = signal_events(decode_profile(profile_frames(spark, sf)))
    routed = ev.withColumn("t_us", F.col("timestamp_ms") * 1000).withColumn(
        "topic", F.when(F.col("signal") == "ProbeFrame", "signals.probe").otherwise("signals.x")
    )
    out, _ = aggregate(routed, WindowConfig(default_seconds=3600, derived=()))
    return (
        out.groupBy("kind", "topic", "signal", "window_start_us", "window_end_us", "sample_count", q4(F.col("mean_value")).alias("mean_value"))
        .agg(F.count("*").alias("copies"))
        .orderBy("window_start_us", "topic", "signal")
    )


@query(
    "u1_union_windows",
    f"""WITH {_DERIVED_SQL} SELECT kind, topic, signal, count(*) AS rows_out, {s4('sum(mean)')} AS total FROM (
      SELECT 'WINDOWED' AS kind, topic, signal, mean FROM judged WHERE reason IS NULL
      UNION ALL SELECT 'DERIVED', topic, signal, mean FROM derived) GROUP BY 1, 2, 3""",
    ("v_signal",),
)
def u1(spark, sf):
    out, _ = aggregate(_routed(spark, sf).where("topic IS NOT NULL"), WINDOWS)
    return out.groupBy("kind", "topic", "signal").agg(F.count("*").alias("rows_out"), q4(F.sum("mean_value")).alias("total"))


_REPLAY_RANGED = """
  ranged AS (SELECT *, CASE signal WHEN 'EngineRPM' THEN value BETWEEN 0 AND 8000 WHEN 'ThrottlePosition' THEN value BETWEEN 0 AND 100
      WHEN 'BrakePedalApplied' THEN value BETWEEN 0 AND 1 WHEN 'VehicleSpeed' THEN value BETWEEN 0 AND 200 WHEN 'CoolantTemp' THEN value BETWEEN -40 AND 180
      WHEN 'IntakeAirTemp' THEN value BETWEEN -40 AND 120 WHEN 'AmbientTemp' THEN value BETWEEN -60 AND 80 WHEN 'EngineOilTemp' THEN value BETWEEN -40 AND 200
      WHEN 'MassAirFlow' THEN value BETWEEN 0 AND 500 WHEN 'TransmissionGear' THEN value BETWEEN 0 AND 8 ELSE value BETWEEN 0 AND 1 END AS fits FROM ev),
  valid AS (SELECT *, CASE WHEN signal = 'ProbeFrame' THEN CAST('0x'||substr(data_hex,13,2) AS BIGINT) & 1 END AS sup FROM ranged WHERE fits),
  sent AS (SELECT *, 'signals.powertrain' AS topic FROM valid WHERE signal IN ('EngineRPM','ThrottlePosition','TransmissionGear','MassAirFlow','CoolantTemp','EngineOilTemp','IntakeAirTemp','VehicleSpeed')
      UNION ALL SELECT *, 'signals.chassis' FROM valid WHERE signal IN ('VehicleSpeed','BrakePedalApplied')),
  agg AS (SELECT topic, signal, (timestamp_ms // 5000) AS w FROM sent GROUP BY ALL),
  der AS (SELECT w FROM agg WHERE topic = 'signals.powertrain' AND signal IN ('EngineRPM','VehicleSpeed') GROUP BY w HAVING count(*) = 2),
  drops AS (SELECT reason FROM g WHERE reason IS NOT NULL UNION ALL SELECT 'RANGE_EXCEEDED' FROM ranged WHERE NOT fits
      UNION ALL SELECT 'NO_ROUTE' FROM valid WHERE signal IN ('AmbientTemp', 'ProbeFrame'))"""


@query(
    "a14_replay_summary",
    f"""WITH {_DECODED_SQL}, {_REPLAY_RANGED}
    SELECT 'frame_count' AS path, count(*) AS value FROM f
    UNION ALL SELECT 'validated_events', count(*) FROM valid
    UNION ALL SELECT 'routed_events', count(*) FROM sent
    UNION ALL SELECT 'aggregated_events', (SELECT count(*) FROM agg) + (SELECT count(*) FROM der)
    UNION ALL SELECT 'diagnostics.count', count(*) FROM drops
    UNION ALL SELECT 'diagnostics.reasons.' || reason, count(*) FROM drops GROUP BY reason
    UNION ALL SELECT 'sink_summary.raw_records_written', count(*) FROM valid WHERE coalesce(sup, 0) = 0
    UNION ALL SELECT 'sink_summary.aggregate_records_written', (SELECT count(*) FROM agg) + (SELECT count(*) FROM der)
    UNION ALL SELECT 'sink_summary.terminal_events_recorded', count(*) FROM valid WHERE sup IS NOT NULL""",
    ("v_can",),
)
def a14(spark, sf):
    return replay_log(profile_frames(spark, sf)).summary()


@query(
    "s15_sink_records",
    f"""WITH {_DECODED_SQL}, {_REPLAY_RANGED}
    SELECT 'raw' AS record_set, count(*) AS records FROM valid WHERE coalesce(sup, 0) = 0
    UNION ALL SELECT 'aggregate', (SELECT count(*) FROM agg) + (SELECT count(*) FROM der) + (SELECT count(*) FROM valid WHERE sup = 0)
    UNION ALL SELECT 'terminal', 2 * count(*) FROM valid WHERE sup IS NOT NULL""",
    ("v_can",),
)
def s15(spark, sf):
    replay = replay_log(profile_frames(spark, sf), rules=(*_default_rules(), Rule("probe", ("Probe*",), ("signals.probe",))))
    return record_counts(sink_records(replay.validated, replay.aggregated))


def _default_rules():
    from roadlake.operators.route import DEFAULT_RULES

    return DEFAULT_RULES


@query(
    "v9_expected_compare",
    """WITH actual AS (SELECT 'n.'||event_type AS path, count(*) AS value FROM events GROUP BY 1),
    expected AS (SELECT 'n.'||event_type AS path, count(*) FILTER (WHERE value >= 0.02e0) AS value FROM events GROUP BY 1
      UNION ALL SELECT 'm.'||event_type, count(*) FROM events WHERE user_id % 2 = 0 GROUP BY 1)
    SELECT e.path, e.value AS expected, a.value AS actual, CASE WHEN a.path IS NULL THEN 'missing' ELSE 'different' END AS problem
    FROM expected e LEFT JOIN actual a USING (path) WHERE a.path IS NULL OR a.value <> e.value""",
)
def v9(spark, sf):
    e = table(spark, sf, "events")
    actual = e.groupBy(F.concat(F.lit("n."), "event_type").alias("path")).agg(F.count("*").alias("value"))
    expected = e.groupBy(F.concat(F.lit("n."), "event_type").alias("path")).agg(F.count_if(F.col("value") >= 0.02).alias("value"))
    more = e.where(F.col("user_id") % 2 == 0).groupBy(F.concat(F.lit("m."), "event_type").alias("path")).agg(F.count("*").alias("value"))
    return compare_summaries(actual, expected.unionByName(more))


@query(
    "st9_monotonic_log",
    """SELECT event_id, t_us, previous FROM (SELECT event_id, device, t_us - (event_id % 97) * 1000000000 AS t_us,
      lag(t_us - (event_id % 97) * 1000000000) OVER (PARTITION BY device ORDER BY event_id) AS previous FROM v_signal) WHERE t_us < previous""",
    ("v_signal",),
)
def st9(spark, sf):
    log = v_signal(spark, sf).withColumn("t_us", F.col("t_us") - F.col("event_id") % 97 * 1_000_000_000)
    return out_of_order(log.select("device", "event_id", "t_us"), ["device"], ["event_id"], "t_us", 1_000_000).select(
        "event_id", "t_us", "previous"
    )


@query(
    "a5_average_speed",
    f"""SELECT device, CAST(t_us - t_us % 10000000 AS BIGINT) AS window_start_us, CAST(t_us - t_us % 10000000 + 10000000 AS BIGINT) AS window_end_us,
    {s4('avg(value)')} AS average_speed, count(*) AS samples, arg_max(session, (t_us, event_id)) AS session
    FROM v_signal GROUP BY ALL""",
    ("v_signal",),
)
def a5(spark, sf):
    out = average_speed(v_signal(spark, sf).withColumnRenamed("value", "speed"))
    return out.withColumn("average_speed", q4(F.col("average_speed")))
