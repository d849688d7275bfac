"""Queries over vehicle dynamics: slip events, the grip envelope, balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlake.operators import dynamics, fixes
from roadlake.plans.driving import hav_sql
from roadlake.plans.registry import q4, query, s4
from roadlake.plans.views import v_gps, v_signal, v_state

KEYS = ["session", "device"]
ORDER = ["t_us", "event_id"]
GAP = 1_500_000


def wheels(spark, sf):
    """Wheel speeds on the one-second grid: undriven wheels at 60, driven ones around it, or unknown."""
    e = F.col("event_id")
    driven = F.when(e % 23 != 0, F.lit(60.0) + (e * 7919 % 31 - 15))
    return v_state(spark, sf).select(*KEYS, *ORDER, dynamics.slip_ratio(driven, F.lit(60.0)).alias("slip"), (e % 1000).cast("double").alias("s_m"))


@query(
    "x4_wheel_slip",
    """WITH w AS (SELECT session, device, t_us, event_id, CASE WHEN event_id%23<>0 THEN 60.0e0+(event_id*7919%31-15) END AS d, CAST(event_id%1000 AS DOUBLE) AS s_m FROM v_state),
    s AS (SELECT *, (d-60.0e0)/greatest(d, 60.0e0) AS slip FROM w), g AS (SELECT *, CASE WHEN d IS NULL THEN NULL ELSE slip END AS sl, lag(t_us) OVER (PARTITION BY session, device ORDER BY t_us, event_id) AS pt FROM s),
    t AS (SELECT *, sum(CASE WHEN t_us-pt>1500000 THEN 1 ELSE 0 END) OVER (PARTITION BY session, device ORDER BY t_us, event_id) AS stretch FROM g),
    h AS (SELECT *, last_value(CASE WHEN sl>=0.15e0 THEN 1 WHEN sl<0.05e0 THEN 0 END IGNORE NULLS) OVER w AS spin, last_value(CASE WHEN -sl>=0.15e0 THEN 1 WHEN -sl<0.05e0 THEN 0 END IGNORE NULLS) OVER w AS locked
      FROM t WINDOW w AS (PARTITION BY session, device, stretch ORDER BY t_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    st AS (SELECT *, CASE WHEN spin=1 THEN 1 WHEN locked=1 THEN -1 ELSE 0 END AS state FROM h),
    l AS (SELECT *, lag(state) OVER (PARTITION BY session, device, stretch ORDER BY t_us, event_id) AS ps FROM st),
    r AS (SELECT *, sum(CASE WHEN state IS DISTINCT FROM ps THEN 1 ELSE 0 END) OVER (PARTITION BY session, device, stretch ORDER BY t_us, event_id) AS run FROM l)
    SELECT session, device, CASE WHEN state=1 THEN 'wheelspin' ELSE 'lockup' END AS kind, min(t_us) AS started_us, max(t_us) AS ended_us, count(*) AS samples, """
    + s4("arg_max(sl, (abs(sl), -t_us, -event_id)) FILTER (WHERE sl IS NOT NULL)") + """ AS peak_slip, arg_max(s_m, (abs(sl), -t_us, -event_id)) FILTER (WHERE sl IS NOT NULL) AS peak_s_m
    FROM r WHERE state<>0 GROUP BY session, device, stretch, run, state""",
    ("v_state",),
)
def x4(spark, sf):
    return dynamics.slip_events(wheels(spark, sf), ORDER, max_gap_us=GAP, chunk=120_000_000).withColumn("peak_slip", q4(F.col("peak_slip")))


_POINTS = """
  pt AS (SELECT session, device, (value-50.0e0)/50.0e0 AS x, sin(event_id) AS y FROM v_signal),
  dp AS (SELECT DISTINCT * FROM pt),
  an AS (SELECT a.session, a.device, a.x, a.y, atan2(b.y-a.y, b.x-a.x) AS th FROM dp a JOIN dp b ON a.session=b.session AND a.device=b.device AND (a.x<>b.x OR a.y<>b.y)),
  gp AS (SELECT *, lead(th) OVER (PARTITION BY session, device, x, y ORDER BY th) - th AS gap, min(th) OVER (PARTITION BY session, device, x, y) + 2*pi() - max(th) OVER (PARTITION BY session, device, x, y) AS round FROM an),
  hull AS (SELECT session, device, x, y FROM gp GROUP BY ALL HAVING max(greatest(coalesce(gap, 0), round)) > pi() + 1e-9)"""


def _accelerations(spark, sf):
    return v_signal(spark, sf).select(*KEYS, ((F.col("value") - 50.0) / 50.0).alias("x"), F.sin(F.col("event_id").cast("double")).alias("y"))


@query("x5_grip_envelope", f"WITH {_POINTS} SELECT session, device, {s4('x')} AS long_g, {s4('y')} AS lat_g FROM hull", ("v_signal",))
def x5(spark, sf):
    return dynamics.envelope(_accelerations(spark, sf)).select(*KEYS, q4(F.col("x")).alias("long_g"), q4(F.col("y")).alias("lat_g"))


@query(
    "x5_grip_used",
    f"""WITH {_POINTS}, oa AS (SELECT *, atan2(y, x) AS th FROM hull),
  od AS (SELECT *, coalesce(lead(th) OVER w - th, min(th) OVER (PARTITION BY session, device) + 2*pi() - th) AS gap, coalesce(lead(x) OVER w, first_value(x) OVER w) AS bx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS b_y
      FROM oa WINDOW w AS (PARTITION BY session, device ORDER BY th)),
  ok AS (SELECT session, device FROM od GROUP BY 1, 2 HAVING max(gap) < pi() AND count(*) >= 3),
  ed AS (SELECT session, device, b_y-y AS nx, x-bx AS ny, (b_y-y)*x + (x-bx)*y AS away FROM od JOIN ok USING (session, device)),
  sh AS (SELECT p.session, p.device, p.x, p.y, max((nx*p.x+ny*p.y)/away) AS used FROM pt p LEFT JOIN ed ON ed.session=p.session AND ed.device=p.device GROUP BY ALL)
  SELECT session, device, count(*) AS points, {s4('avg(used)')} AS mean_used, count(*) FILTER (WHERE used >= 0.8e0) AS near_limit FROM sh GROUP BY 1, 2""",
    ("v_signal",),
)
def x5u(spark, sf):
    samples = _accelerations(spark, sf)
    used = dynamics.grip_used(samples.distinct(), dynamics.envelope(samples))
    return used.groupBy(*KEYS).agg(F.count("*").alias("points"), q4(F.avg("grip_used")).alias("mean_used"), F.count_if(F.col("grip_used") >= 0.8).alias("near_limit"))


_YAW = """
  sm AS (SELECT device, event_id, 4.0e0 + event_id%30 AS v, 0.3e0*sin(event_id) AS r, value FROM v_signal),
  sp AS (SELECT device, event_id, v, r, (2.5e0 + length(device)*0.1e0)*(r/v) + 0.0035e0*(r*v) + 0.01e0 + (value-50.0e0)/1e6 AS d FROM sm),
  su AS (SELECT device, count(*) AS n, avg(r/v) AS x, avg(r*v) AS y, avg(d) AS d, avg((r/v)*(r/v)) AS xx, avg((r/v)*(r*v)) AS xy, avg((r*v)*(r*v)) AS yy, avg((r/v)*d) AS xd, avg((r*v)*d) AS yd FROM sp GROUP BY 1),
  ce AS (SELECT device, n, x, y, d, xx-x*x AS xx, yy-y*y AS yy, xy-x*y AS xy, xd-x*d AS xd, yd-y*d AS yd FROM su),
  mo AS (SELECT device, n, (xd*yy-yd*xy)/(xx*yy-xy*xy) AS base, (yd*xx-xd*xy)/(xx*yy-xy*xy) AS gradient, x, y, d FROM ce)"""


def _turning(spark, sf):
    """Samples of cars with a wheelbase of 2.7 m, a gradient of 0.0035 and a wheel that is 0.01 off."""
    e = F.col("event_id")
    v, r = F.lit(4.0) + e % 30, F.lit(0.3) * F.sin(e.cast("double"))
    steer = (F.lit(2.5) + F.length("device") * 0.1) * (r / v) + F.lit(0.0035) * (r * v) + 0.01 + (F.col("value") - 50.0) / 1e6
    return v_signal(spark, sf).select("device", "event_id", v.alias("speed_mps"), r.alias("yaw_rate"), steer.alias("steer_rad"))


@query("x3_balance_model", f"WITH {_YAW} SELECT device, n AS samples, {s4('base')} AS wheelbase, {s4('gradient')} AS gradient, {s4('d-base*x-gradient*y')} AS steer_offset FROM mo", ("v_signal",))
def x3(spark, sf):
    model = dynamics.balance_model(_turning(spark, sf), ["device"])
    return model.select("device", "samples", q4(F.col("wheelbase")).alias("wheelbase"), q4(F.col("gradient")).alias("gradient"), q4(F.col("offset")).alias("steer_offset"))


@query(
    "x3_balance",
    f"""WITH {_YAW}, ex AS (SELECT sp.*, (sp.d-(mo.d-base*x-gradient*y))*v/base AS expected FROM sp JOIN mo USING (device)),
  ba AS (SELECT *, CASE WHEN abs(expected)>1e-3 THEN r/expected-1 END AS excess FROM ex)
  SELECT device, CASE WHEN excess < -0.05e0 THEN 'understeer' WHEN excess > 0.05e0 THEN 'oversteer' WHEN excess IS NOT NULL THEN 'neutral' END AS balance, count(*) AS samples, {s4('avg(excess)')} AS mean_excess FROM ba GROUP BY 1, 2""",
    ("v_signal",),
)
def x3b(spark, sf):
    samples = _turning(spark, sf)
    out = dynamics.balance(samples, dynamics.balance_model(samples, ["device"]), ["device"])
    return out.groupBy("device", "balance").agg(F.count("*").alias("samples"), q4(F.avg("excess")).alias("mean_excess"))


_FIXES = f"""
  fx AS (SELECT session, device, event_id, t_us//20000 AS t, lat, lon, CASE WHEN event_id%17=0 THEN 9.0e0 ELSE 1.5e0 END AS hdop, CASE WHEN event_id%23<>0 THEN event_id%11+3 END AS sats FROM v_gps),
  jf AS (SELECT *, CASE WHEN hdop>5 THEN 'POOR_HDOP' WHEN sats<4 THEN 'FEW_SATELLITES' END AS poor FROM fx),
  sq AS (SELECT *, row_number() OVER (PARTITION BY session, device ORDER BY t, event_id) AS n FROM jf WHERE poor IS NULL),
  gate AS (
      SELECT session, device, event_id, n, true AS ok, t AS gt, lat AS ala, lon AS alo, CAST(NULL AS BIGINT) AS ot, CAST(NULL AS DOUBLE) AS ola, CAST(NULL AS DOUBLE) AS olo, 0 AS run FROM sq WHERE n=1
      UNION ALL
      SELECT session, device, event_id, n, near OR run>=3, CASE WHEN near OR run>=3 THEN t ELSE gt END, CASE WHEN near OR run>=3 THEN lat ELSE ala END, CASE WHEN near OR run>=3 THEN lon ELSE alo END,
             CASE WHEN near OR run>=3 THEN NULL ELSE t END, CASE WHEN near OR run>=3 THEN NULL ELSE lat END, CASE WHEN near OR run>=3 THEN NULL ELSE lon END, CASE WHEN near OR run>=3 THEN 0 ELSE run END
      FROM (SELECT s.*, g.gt, g.ala, g.alo, {hav_sql('g.ala', 'g.alo', 's.lat', 's.lon', '6371000.0e0', 'asin')}*3.6e6 <= 400.0e0*greatest(s.t-g.gt, 0) AS near,
             CASE WHEN g.ot IS NOT NULL AND {hav_sql('g.ola', 'g.olo', 's.lat', 's.lon', '6371000.0e0', 'asin')}*3.6e6 <= 400.0e0*greatest(s.t-g.ot, 0) THEN g.run+1 ELSE 1 END AS run
           FROM gate g JOIN sq s ON s.session=g.session AND s.device=g.device AND s.n=g.n+1))"""


@query("x7_bad_fixes", f"WITH RECURSIVE {_FIXES} SELECT jf.event_id, jf.session, coalesce(poor, CASE WHEN NOT ok THEN 'IMPOSSIBLE_JUMP' END, 'ok') AS reason FROM jf LEFT JOIN gate USING (event_id)", ("v_gps",))
def x7(spark, sf):
    """Fixes a few seconds and a few hundred metres apart, so that many a jump is not to be believed."""
    e = F.col("event_id")
    rows = v_gps(spark, sf).select(*KEYS, F.floor(F.col("t_us") / 20_000).alias("t_us"), "event_id", "lat", "lon", F.when(e % 17 == 0, 9.0).otherwise(1.5).alias("hdop"), F.when(e % 23 != 0, e % 11 + 3).alias("num_sats"))
    out = fixes.judge_fixes(rows, ORDER, agreeing=3, chunk=60_000_000)
    return out.select("event_id", "session", F.coalesce("reason", F.lit("ok")).alias("reason"))
