"""Queries over fixes, tracks, laps, routes, as-of joins and device sequences."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from roadlake.operators import asof, device, lap_machine, laps, routes, tracks
from roadlake.operators.ordered import DAY_US
from roadlake.session import cut_lineage
from roadlake.plans.registry import even_sql, q4, query, s4
from roadlake.plans.views import TRACK_POINTS, events, spread_table, table, v_gps, v_signal, v_state, v_trackpos
from roadlake.sources import geojson

ORDER = ["t_us", "event_id"]
KEYS = ["session", "device"]
HALF_MONTH = 15 * DAY_US


def loop(spark):
    """The fixed loop of the view, as a one-row track table."""
    points = spark.createDataFrame([(1, "loop", TRACK_POINTS)], "track_id long, name string, points array<struct<lat:double,lon:double>>")
    return geojson.track_segments(points).withColumn("track_order", F.lit(0))


def hav_sql(lat1, lon1, lat2, lon2, radius="6371000.0e0", form="atan2"):
    a = (f"(sin(radians({lat2}-({lat1}))/2)*sin(radians({lat2}-({lat1}))/2)+cos(radians({lat1}))*cos(radians({lat2}))"
         f"*sin(radians({lon2}-({lon1}))/2)*sin(radians({lon2}-({lon1}))/2))")
    return f"(2*{radius}*atan2(sqrt({a}), sqrt(1-{a})))" if form == "atan2" else f"(2*{radius}*asin(sqrt({a})))"


_MATCH = f"""
  seg AS (SELECT *, {hav_sql('lat1', 'lon1', 'lat2', 'lon2')} AS len FROM v_track),
  segs AS (SELECT *, coalesce(sum(len) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0, sum(len) OVER () AS total FROM seg),
  pl AS (SELECT g.event_id, g.session, g.device, g.t_us, g.lat, g.lon, s.seq, s.s0, s.total, s.lat1, s.lon1, s.lat2, s.lon2, 111320.0e0*cos(radians((lat1+lat2+lat)/3)) AS k FROM v_gps g, segs s),
  pr AS (SELECT *, (lon2-lon1)*k AS bx, (lat2-lat1)*111320.0e0 AS by_, (lon-lon1)*k AS px, (lat-lat1)*111320.0e0 AS py FROM pl),
  tt AS (SELECT *, greatest(0, least(1, (px*bx+py*by_)/(bx*bx+by_*by_))) AS t FROM pr),
  ds AS (SELECT *, sqrt((px-t*bx)*(px-t*bx)+(py-t*by_)*(py-t*by_)) AS dist, t*sqrt(bx*bx+by_*by_) AS along FROM tt),
  best AS (SELECT * FROM ds QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY dist, seq) = 1),
  hit AS (SELECT *, s0+along AS s_m FROM best WHERE dist <= 75)"""


@query("j3_nearest_segment", f"WITH {_MATCH} SELECT event_id, seq, floor(dist*1000+0.5)/1000 AS distance_m FROM hit", ("v_gps", "v_track"))
def j3(spark, sf):
    out = tracks.match_tracks(v_gps(spark, sf), loop(spark))
    return out.select("event_id", F.col("m.seq").alias("seq"), (F.floor(F.col("m.distance_m") * 1000 + 0.5) / 1000).alias("distance_m"))


@query(
    "d7_track_position",
    f"""WITH {_MATCH} SELECT event_id, session, device, CAST(1 AS BIGINT) AS track_id, 'loop' AS track_name, floor(s_m*1000+0.5e0)/1000 AS s_m, floor(s_m/total*100.0e0*1000+0.5e0)/1000 AS progress_pct,
    floor(dist*1000+0.5e0)/1000 AS distance_to_track_m, {s4('lat1+(lat2-lat1)*t')} AS snapped_latitude, {s4('lon1+(lon2-lon1)*t')} AS snapped_longitude, floor(total*1000+0.5e0)/1000 AS track_length_m FROM hit""",
    ("v_gps", "v_track"),
)
def d7(spark, sf):
    out = tracks.track_positions(v_gps(spark, sf), loop(spark))
    return out.select(
        "event_id", *KEYS, "track_id", "track_name", "s_m", "progress_pct", "distance_to_track_m",
        q4(F.col("snapped_latitude")).alias("snapped_latitude"), q4(F.col("snapped_longitude")).alias("snapped_longitude"), "track_length_m",
    )


# ---- tracks from GeoJSON text made of the suppliers ----

def supplier_tracks(spark, sf):
    k = F.col("s_suppkey")

    def line(start, n):
        pts = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.concat(F.lit("["), ((k * 3 + (start + i) * 7) % 180 - 90 + (start + i)).cast("string"), F.lit(","), ((k * 5 + (start + i) * 11) % 80).cast("string"), F.lit("]")),
        )
        return F.concat(F.lit("["), F.array_join(pts, ","), F.lit("]"))

    n = (k % 4 + 1).cast("int")
    single = F.concat(F.lit('{"type":"LineString","coordinates":'), line(F.lit(0), n), F.lit("}"))
    second = F.when(k % 2 == 0, n - 1).otherwise(n)
    multi = F.concat(F.lit('{"type":"MultiLineString","coordinates":['), line(F.lit(0), n), F.lit(","), line(second, F.lit(3)), F.lit("]}"))
    point = F.lit('{"type":"Point","coordinates":[1,2]}')
    wrapped = F.concat(F.lit('{"type":"Feature","properties":{},"geometry":'), single, F.lit("}"))
    collection = F.concat(F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":'), point, F.lit("},"), wrapped, F.lit("]}"))
    text = F.when(k % 5 == 0, single).when(k % 5 == 1, multi).when(k % 5 == 2, wrapped).when(k % 5 == 3, collection).otherwise(point)
    return spread_table(spark, sf, "supplier", ["s_suppkey", "s_name"], ["s_suppkey"]).select(k.alias("track_id"), F.when(k % 3 != 0, F.col("s_name")).alias("name"), text.alias("geometry"))


_SUPPLIER = """
  tr AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey%3<>0 THEN s_name ELSE 'track-'||s_suppkey END AS name, s_suppkey%4+1 AS n FROM supplier),
  raw AS (SELECT k, name, i AS pos, i AS pt FROM tr, range(10) r(i) WHERE k%5 IN (0,2,3) AND i<n
      UNION ALL SELECT k, name, i, i FROM tr, range(10) r(i) WHERE k%5=1 AND i<n
      UNION ALL SELECT k, name, 100+i, CASE WHEN k%2=0 THEN n-1 ELSE n END + i FROM tr, range(3) r(i) WHERE k%5=1 AND NOT (k%2=0 AND i=0)),
  pts AS (SELECT *, CAST((k*5+pt*11)%80 AS DOUBLE) AS lat, CAST((k*3+pt*7)%180-90+pt AS DOUBLE) AS lon, row_number() OVER (PARTITION BY k ORDER BY pos)-1 AS seq, count(*) OVER (PARTITION BY k) AS c FROM raw),
  sg AS (SELECT k, name, seq, lat AS lat1, lon AS lon1, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM pts WHERE c>=2 WINDOW w AS (PARTITION BY k ORDER BY seq))"""


@query(
    "s11_track_segments",
    f"""WITH {_SUPPLIER}, ln AS (SELECT *, {hav_sql('lat1', 'lon1', 'lat2', 'lon2')} AS len FROM sg WHERE lat2 IS NOT NULL)
    SELECT k AS track_id, name, CAST(seq AS INTEGER) AS seq, lat1, lon2, {s4('len')} AS len_m, {s4('sum(len) OVER (PARTITION BY k ORDER BY seq) - len')} AS s_start_m, {s4('sum(len) OVER (PARTITION BY k)')} AS track_length_m FROM ln""",
)
def s11(spark, sf):
    out = geojson.track_segments(geojson.track_points(supplier_tracks(spark, sf)))
    return out.select("track_id", "name", "seq", "lat1", "lon2", q4(F.col("len_m")).alias("len_m"), q4(F.col("s_start_m")).alias("s_start_m"), q4(F.col("track_length_m")).alias("track_length_m"))


@query(
    "t2_tracks_nearest",
    f"""WITH {_SUPPLIER} SELECT k AS track_id, name, {s4("round_even(" + hav_sql('40.0e0', '-111.0e0', '(min(lat)+max(lat))/2', '(min(lon)+max(lon))/2', '6371.0088e0', 'asin') + ",2)")} AS distance_km FROM pts WHERE c>=2 GROUP BY ALL""",
)
def t2(spark, sf):
    centers = tracks.track_centers(geojson.track_points(supplier_tracks(spark, sf)))
    return tracks.tracks_nearest_first(centers, 40.0, -111.0).select("track_id", "name", q4(F.col("distance_km")).alias("distance_km"))


@query(
    "t3_nearest_route_point",
    f"""WITH d AS (SELECT session, event_id, t_us, sqrt(((lat-40.005e0)*111195.0e0)*((lat-40.005e0)*111195.0e0)+((lon+110.995e0)*111195.0e0*cos(radians(40.005e0)))*((lon+110.995e0)*111195.0e0*cos(radians(40.005e0)))) AS dist FROM v_gps)
    SELECT session, arg_min(event_id,(dist,t_us,event_id)) AS event_id, {s4('min(dist)')} AS distance_m FROM d WHERE dist<=60 GROUP BY 1""",
    ("v_gps",),
)
def t3(spark, sf):
    out = tracks.nearest_route_point(v_gps(spark, sf), ["session"], 40.005, -110.995, 60.0, ORDER)
    return out.select("session", "event_id", q4(F.col("distance_m")).alias("distance_m"))


@query(
    "a9_session_list",
    """SELECT session, device, track_id, max(track_name) AS track_name, max(track_length_m) AS track_length_m, min(t_us) AS started_us, max(t_us) AS ended_us, count(*) AS sample_count
    FROM v_trackpos GROUP BY 1,2,3 ORDER BY max(t_us) DESC, session, device LIMIT 100""",
    ("v_trackpos",),
)
def a9(spark, sf):
    return tracks.session_list(v_trackpos(spark, sf))


# ---- laps over arc length ----

_LAPS = """
  lg AS (SELECT *, lag(s_m) OVER (PARTITION BY session ORDER BY t_us, event_id) AS ps FROM v_trackpos),
  lp AS (SELECT *, 1 + sum(CASE WHEN ps - s_m > 400.0e0 THEN 1 ELSE 0 END) OVER (PARTITION BY session ORDER BY t_us, event_id) AS lap FROM lg),
  lt AS (SELECT session, lap, min(t_us) AS t0, max(t_us) AS t1, count(*) AS n, arg_min(s_m,(t_us,event_id)) AS fs, arg_max(s_m,(t_us,event_id)) AS ls,
      arg_min(struct_pack(v:=speed),(t_us,event_id)).v AS fv, arg_max(struct_pack(v:=speed),(t_us,event_id)).v AS lv FROM lp GROUP BY ALL),
  prs AS (SELECT session, lap, t_us, event_id, s_m, speed, lead(s_m) OVER w AS s2, lead(t_us) OVER w AS t2, lead(speed) OVER w AS v2 FROM lp WINDOW w AS (PARTITION BY session, lap ORDER BY t_us, event_id)),
  prz AS (SELECT session, lap, t_us, event_id, s_m, speed, coalesce(s2, s_m) AS s2, coalesce(t2, t_us) AS t2, CASE WHEN s2 IS NULL THEN speed ELSE v2 END AS v2 FROM prs)"""
_ELAPSED = _LAPS + """,
  hits AS (SELECT p.*, g*50.0e0 AS target FROM prz p, range(0, 21) r(g) WHERE g*50.0e0 BETWEEN s_m AND s2),
  fst AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY session, lap, target ORDER BY t_us, event_id)=1),
  el AS (SELECT f.session, f.lap, target, (CASE WHEN s2=s_m THEN t2 ELSE t_us + (target-s_m)/(s2-s_m)*(t2-t_us) END - t0)/1e6 AS e FROM fst f JOIN lt USING (session, lap) WHERE target BETWEEN fs AND ls)"""


def _lapped(spark, sf):
    return laps.laps_of(v_trackpos(spark, sf), ORDER, chunk=HALF_MONTH)


@query("w2_lap_split", f"WITH {_LAPS} SELECT event_id, session, CAST(lap AS BIGINT) AS lap FROM lp", ("v_trackpos",))
def w2(spark, sf):
    return laps.split_laps(v_trackpos(spark, sf), ORDER, chunk=HALF_MONTH).select("event_id", "session", "lap")


@query(
    "x6_sample_positions",
    f"""WITH {_LAPS}, g AS (SELECT event_id, 'u'||user_id AS session, epoch_us(ts)+1800000000 AS t_us FROM events),
    a AS (SELECT g.*, p.t_us AS ta, p.s_m AS sa, p.lap AS la FROM g ASOF LEFT JOIN lp p ON g.session=p.session AND g.t_us>=p.t_us),
    b AS (SELECT a.*, p.t_us AS tb, p.s_m AS sb, p.lap AS lb FROM a ASOF LEFT JOIN lp p ON a.session=p.session AND a.t_us<p.t_us),
    u AS (SELECT *, CASE WHEN tb-ta<=172800000000 THEN sa+(t_us-ta)/(tb-ta)*(sb+(lb-la)*1000.0e0-sa) END AS ahead FROM b)
    SELECT event_id, session, {s4('CASE WHEN lb>la AND ahead>=1000.0e0 THEN ahead-(lb-la)*1000.0e0 ELSE ahead END')} AS s_m, CAST(CASE WHEN ahead IS NOT NULL THEN CASE WHEN lb>la AND ahead>=1000.0e0 THEN lb ELSE la END END AS BIGINT) AS lap FROM u""",
    ("v_trackpos",),
)
def x6(spark, sf):
    """A sample half an hour after every event, between the fixes around it; gaps of more than two days stay open."""
    samples = events(spark, sf).select("event_id", F.concat(F.lit("u"), "user_id").alias("session"), (F.col("t_us") + 1_800_000_000).alias("t_us"))
    out = laps.place_samples(samples, v_trackpos(spark, sf), ORDER, chunk=HALF_MONTH, max_gap_us=172_800_000_000)
    return out.select("event_id", "session", q4(F.col("s_m")).alias("s_m"), "lap")


@query("w3_lap_summary", f"WITH {_LAPS} SELECT session, CAST(lap AS BIGINT) AS lap, t0 AS started_us, t1 AS ended_us, n AS samples, (t1-t0)/1e6 AS duration_s FROM lt", ("v_trackpos",))
def w3(spark, sf):
    numbered = laps.split_laps(v_trackpos(spark, sf), ORDER, chunk=HALF_MONTH)
    return laps.lap_table(numbered, ORDER).select("session", "lap", "started_us", "ended_us", "samples", "duration_s")


@query("j9_elapsed_lookup", f"WITH {_ELAPSED} SELECT session, CAST(lap AS BIGINT) AS lap, target AS target_m, {s4('e')} AS elapsed_s FROM el", ("v_trackpos",))
def j9(spark, sf):
    out = laps.elapsed_on_grid(_lapped(spark, sf), ORDER, 50.0, chunk=HALF_MONTH)
    return out.select("session", "lap", "target_m", q4(F.col("elapsed_s")).alias("elapsed_s"))


@query(
    "w12_delta_trace",
    f"""WITH {_ELAPSED} SELECT a.session AS ref_session, CAST(a.lap AS BIGINT) AS ref_lap, CAST(b.lap AS BIGINT) AS cmp_lap, a.target AS s_m, {s4(even_sql('a.e', 3))} AS reference_elapsed_s, {s4(even_sql('b.e-a.e', 3))} AS delta_s
    FROM el a JOIN el b ON a.session=b.session AND b.lap=a.lap+1 AND a.target=b.target""",
    ("v_trackpos",),
)
def w12(spark, sf):
    numbered = _lapped(spark, sf)
    elapsed = laps.elapsed_on_grid(numbered, ORDER, 50.0, chunk=HALF_MONTH)
    pairs = laps.lap_table(numbered, ORDER).select(
        F.col("session").alias("ref_session"), F.col("lap").alias("ref_lap"), F.col("session").alias("cmp_session"), (F.col("lap") + 1).alias("cmp_lap"))
    out = laps.delta_trace(elapsed, pairs)
    return out.select("ref_session", "ref_lap", "cmp_lap", "s_m", q4(F.col("reference_elapsed_s")).alias("reference_elapsed_s"), q4(F.col("delta_s")).alias("delta_s"))


SEGMENTS = [("S1", 100.0, 400.0), ("S2", 400.0, 700.0), ("wide", 50.0, 950.0), ("bad", 300.0, 300.0)]


@query(
    "w13_segment_stats",
    f"""WITH {_LAPS}, sgm AS (SELECT * FROM (VALUES ('S1',100.0e0,400.0e0),('S2',400.0e0,700.0e0),('wide',50.0e0,950.0e0)) t(name,a,b)), tg AS (SELECT DISTINCT x FROM (SELECT a AS x FROM sgm UNION ALL SELECT b FROM sgm)),
    hits AS (SELECT p.*, x AS target FROM prz p, tg WHERE x BETWEEN s_m AND s2), fst AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY session, lap, target ORDER BY t_us, event_id)=1),
    tgt AS (SELECT f.session, f.lap, target, (CASE WHEN s2=s_m THEN t2 ELSE t_us + (target-s_m)/(s2-s_m)*(t2-t_us) END - t0)/1e6 AS e,
      CASE WHEN target<=fs THEN fv WHEN target>=ls THEN lv WHEN speed IS NULL THEN v2 WHEN v2 IS NULL THEN speed WHEN s2=s_m THEN v2 ELSE speed+(target-s_m)/(s2-s_m)*(v2-speed) END AS v FROM fst f JOIN lt USING (session, lap) WHERE target BETWEEN fs AND ls),
    ins AS (SELECT session, lap, name, min(speed) AS lo, avg(speed) AS mean, max(speed) AS hi FROM lp JOIN sgm ON s_m BETWEEN a AND b WHERE speed IS NOT NULL GROUP BY ALL)
    SELECT x.session, CAST(x.lap AS BIGINT) AS lap, g.name, {s4(even_sql('y.e-x.e', 3))} AS duration_s, {s4(even_sql('x.v', 3))} AS entry_speed_kph, {s4(even_sql('y.v', 3))} AS exit_speed_kph, {s4(even_sql('lo', 3))} AS min_speed_kph, {s4(even_sql('mean', 3))} AS mean_speed_kph, {s4(even_sql('hi', 3))} AS max_speed_kph
    FROM sgm g JOIN tgt x ON x.target=g.a JOIN tgt y ON y.target=g.b AND y.session=x.session AND y.lap=x.lap LEFT JOIN ins i ON i.session=x.session AND i.lap=x.lap AND i.name=g.name""",
    ("v_trackpos",),
)
def w13(spark, sf):
    out = laps.segment_stats(_lapped(spark, sf), ORDER, SEGMENTS, chunk=HALF_MONTH)
    return out.select("session", "lap", "name", *[q4(F.col(c)).alias(c) for c in out.columns if c.endswith(("_s", "_kph"))])


# ---- routes ----

_ROUTE = """
  rt AS (SELECT session, device, event_id, t_us, round_even((t_us - min(t_us) OVER (PARTITION BY session, device))/1e6,1) AS s, lat, lon, coalesce(speed_kph, gps_speed_kph) AS kph, rpm, throttle_pct, gear, prndl, brake_on, brake_kpa FROM v_state),
  loc AS (SELECT * FROM rt WHERE lat IS NOT NULL AND lon IS NOT NULL)"""


@query("w14_route_rows", f"WITH {_ROUTE} SELECT session, device, {s4('s')} AS s, lat, lon, {s4(even_sql('kph', 1))} AS speed_kph, {s4(even_sql('rpm', 1))} AS rpm, gear, prndl, brake_on, brake_kpa FROM loc", ("v_state",))
def w14(spark, sf):
    out = routes.route_rows(v_state(spark, sf))
    return out.select(*KEYS, q4(F.col("s")).alias("s"), "lat", "lon", q4(F.col("speed_kph")).alias("speed_kph"), q4(F.col("rpm")).alias("rpm"), "gear", "prndl", "brake_on", "brake_kpa")


@query(
    "w15_route_runs",
    f"""WITH {_ROUTE}, b AS (SELECT *, CASE WHEN prndl<>'D' THEN prndl WHEN gear BETWEEN 1 AND 10 THEN CAST(CAST(gear AS INTEGER) AS VARCHAR) ELSE 'no value' END AS band FROM loc),
    l AS (SELECT *, lag(s) OVER w AS ps, lag(band) OVER w AS pb FROM b WINDOW w AS (PARTITION BY session, device ORDER BY t_us, event_id)),
    n AS (SELECT *, sum(CASE WHEN ps IS NULL OR s-ps>5 OR band<>pb THEN 1 ELSE 0 END) OVER (PARTITION BY session, device ORDER BY t_us, event_id) AS run FROM l),
    p AS (SELECT session, device, run, band, s, lat, lon FROM n UNION ALL SELECT session, device, run-1, pb, s, lat, lon FROM n WHERE ps IS NOT NULL AND s-ps<=5 AND band<>pb)
    SELECT session, device, CAST(run AS BIGINT) AS run, band, count(*) AS points, {s4('min(s)')} AS from_s, {s4('max(s)')} AS to_s, min(lat) AS south, min(lon) AS west, max(lat) AS north, max(lon) AS east FROM p GROUP BY ALL HAVING count(*)>=2""",
    ("v_state",),
)
def w15(spark, sf):
    points = routes.band_points(routes.route_rows(v_state(spark, sf)), "gear", ORDER, chunk=120_000_000)
    out = routes.band_runs(points)
    return out.select(*KEYS, "run", "band", "points", q4(F.col("from_s")).alias("from_s"), q4(F.col("to_s")).alias("to_s"), "south", "west", "north", "east")


_BANDS = f"""
  bd AS (SELECT 'speed_mph' AS coloured, session, device, t_us, event_id, s, CASE WHEN {even_sql('kph', 1)}<20*1.609344e0 THEN '<20' WHEN {even_sql('kph', 1)}<40*1.609344e0 THEN '20-40' WHEN {even_sql('kph', 1)}<55*1.609344e0 THEN '40-55' WHEN kph IS NOT NULL THEN '55+' END AS band FROM loc
    UNION ALL SELECT 'speed_kph', session, device, t_us, event_id, s, CASE WHEN {even_sql('kph', 1)}<30 THEN '<30' WHEN {even_sql('kph', 1)}<60 THEN '30-60' WHEN {even_sql('kph', 1)}<90 THEN '60-90' WHEN kph IS NOT NULL THEN '90+' END FROM loc
    UNION ALL SELECT 'throttle', session, device, t_us, event_id, s, CASE WHEN throttle_pct<10 THEN '<10%' WHEN throttle_pct<30 THEN '10-30%' WHEN throttle_pct<60 THEN '30-60%' WHEN throttle_pct IS NOT NULL THEN '60%+' END FROM loc
    UNION ALL SELECT 'brake', session, device, t_us, event_id, s, CASE WHEN brake_kpa<20 THEN 'off' WHEN brake_kpa<70 THEN 'light' WHEN brake_kpa<110 THEN 'medium' WHEN brake_kpa<150 THEN 'firm' WHEN brake_kpa IS NOT NULL THEN 'hard' WHEN brake_on THEN 'on' ELSE 'off' END FROM loc
    UNION ALL SELECT 'rpm', session, device, t_us, event_id, s, CASE WHEN {even_sql('rpm', 1)}<1500 THEN '<1500' WHEN {even_sql('rpm', 1)}<2500 THEN '1500-2500' WHEN {even_sql('rpm', 1)}<3500 THEN '2500-3500' WHEN rpm IS NOT NULL THEN '3500+' END FROM loc),
  bn AS (SELECT * REPLACE (coalesce(band, 'no value') AS band) FROM bd),
  bl AS (SELECT *, lag(s) OVER w AS ps, lag(band) OVER w AS pb FROM bn WINDOW w AS (PARTITION BY coloured, session, device ORDER BY t_us, event_id)),
  br AS (SELECT *, sum(CASE WHEN ps IS NULL OR s-ps>5 OR band<>pb THEN 1 ELSE 0 END) OVER (PARTITION BY coloured, session, device ORDER BY t_us, event_id) AS run FROM bl),
  bp AS (SELECT coloured, session, device, run, band, s FROM br UNION ALL SELECT coloured, session, device, run-1, pb, s FROM br WHERE ps IS NOT NULL AND s-ps<=5 AND band<>pb)"""


@query(
    "w15_route_bands",
    f"WITH {_ROUTE}, {_BANDS} SELECT coloured, session, device, CAST(run AS BIGINT) AS run, band, count(*) AS points, {s4('min(s)')} AS from_s, {s4('max(s)')} AS to_s FROM bp GROUP BY ALL HAVING count(*)>=2",
    ("v_state",),
)
def w15b(spark, sf):
    """The other bands: speed in both units, throttle, brake, engine speed. The route is made once."""
    rows, out = cut_lineage(routes.route_rows(v_state(spark, sf))), None
    for coloured, by, imperial in (("speed_mph", "speed", True), ("speed_kph", "speed", False), ("throttle", "throttle", True), ("brake", "brake", True), ("rpm", "rpm", True)):
        runs = routes.band_runs(routes.band_points(rows, by, ORDER, imperial, chunk=120_000_000)).select(F.lit(coloured).alias("coloured"), *KEYS, "run", "band", "points", q4(F.col("from_s")).alias("from_s"), q4(F.col("to_s")).alias("to_s"))
        out = runs if out is None else out.unionByName(runs)
    return out


@query(
    "v8_trip_meter",
    f"""WITH a AS (SELECT session, device, lat, lon, event_id%7*0.5e0 AS v, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM v_gps WHERE event_id%40<=25 AND event_id%9<>0 WINDOW w AS (PARTITION BY session, device ORDER BY t_us, event_id))
    SELECT session, device, {s4("coalesce(sum(CASE WHEN v>=1 THEN " + hav_sql('plat', 'plon', 'lat', 'lon', '6371.0088e0', 'asin') + "*1000 END),0)")} AS distance_m FROM a GROUP BY 1,2""",
    ("v_gps",),
)
def v8(spark, sf):
    e = F.col("event_id")
    fixes = v_gps(spark, sf).withColumn("accuracy_m", F.when(e % 9 != 0, e % 40).cast("double")).withColumn("speed_mps", e % 7 * F.lit(0.5))
    return routes.trip_distance(fixes, ORDER, chunk=HALF_MONTH).withColumn("distance_m", q4(F.col("distance_m")))


# ---- as-of joins: a grid of six-hour ticks against the samples of each session ----

_ASOF = """
  ends AS (SELECT session, min(t_us)//21600000000 AS a, max(t_us)//21600000000+1 AS b FROM v_signal GROUP BY 1),
  grid AS (SELECT session, k*21600000000 AS t_us FROM ends, range(0, 4000) r(i), (SELECT 0) z, LATERAL (SELECT a+i AS k) WHERE k<=b)"""


def _grid(spark, sf):
    step = 21_600_000_000
    ends = v_signal(spark, sf).groupBy("session").agg(F.floor(F.min("t_us") / step).alias("a"), (F.floor(F.max("t_us") / step) + 1).alias("b"))
    return ends.select("session", F.explode(F.transform(F.sequence("a", "b"), lambda i: i * step)).alias("t_us"))


def _samples(spark, sf):
    return v_signal(spark, sf).select("session", "t_us", "event_id", "value")


@query("j6_asof_hold", f"WITH {_ASOF} SELECT g.session, g.t_us, s.value AS held FROM grid g ASOF LEFT JOIN v_signal s ON g.session=s.session AND g.t_us>=s.t_us", ("v_signal",))
def j6(spark, sf):
    return asof.hold(_grid(spark, sf), _samples(spark, sf), ["session"], "t_us", "event_id", F.col("value"), "held", HALF_MONTH)


@query(
    "j7_asof_interpolate",
    f"""WITH {_ASOF}, b AS (SELECT g.session, g.t_us, s.t_us AS ta, s.value AS va FROM grid g ASOF LEFT JOIN v_signal s ON g.session=s.session AND g.t_us>=s.t_us),
    c AS (SELECT b.*, s.t_us AS tb, s.value AS vb FROM b ASOF LEFT JOIN v_signal s ON b.session=s.session AND b.t_us<s.t_us)
    SELECT session, t_us, {s4('CASE WHEN ta IS NULL THEN vb WHEN tb IS NULL THEN va ELSE va+(t_us-ta)/(tb-ta)*(vb-va) END')} AS value FROM c""",
    ("v_signal",),
)
def j7(spark, sf):
    out = asof.interpolate(_grid(spark, sf), _samples(spark, sf), ["session"], "t_us", "event_id", F.col("value"), "v", HALF_MONTH)
    return out.select("session", "t_us", q4(F.col("v")).alias("value"))


@query(
    "j8_nearest_sample",
    f"""WITH {_ASOF}, b AS (SELECT g.session, g.t_us, s.t_us AS ta, s.value AS va FROM grid g ASOF LEFT JOIN v_signal s ON g.session=s.session AND g.t_us>s.t_us),
    c AS (SELECT b.*, s.t_us AS tb, s.value AS vb FROM b ASOF LEFT JOIN v_signal s ON b.session=s.session AND b.t_us<=s.t_us)
    SELECT session, t_us, CASE WHEN tb IS NULL OR t_us-ta<=tb-t_us THEN va ELSE vb END AS value, CASE WHEN tb IS NULL OR t_us-ta<=tb-t_us THEN t_us-ta ELSE tb-t_us END AS gap_us FROM c""",
    ("v_signal",),
)
def j8(spark, sf):
    out = asof.nearest(_grid(spark, sf), _samples(spark, sf), ["session"], "t_us", "event_id", F.col("value"), "v", HALF_MONTH)
    return out.select("session", "t_us", F.col("v").alias("value"), F.col("v_gap").alias("gap_us"))


PROFILES = (
    lap_machine.Profile(profile_id="base"), lap_machine.Profile(profile_id="customers-0001", prefix="customer#00000001"),
    lap_machine.Profile(profile_id="customers-000", prefix="Customer#000000"), lap_machine.Profile(profile_id="never", prefix="customer#0000000010"),
)


@query(
    "j5_prefix_profile",
    """SELECT c_custkey, CASE WHEN upper(d) LIKE 'CUSTOMER#00000001%' THEN 'customers-0001' WHEN upper(d) LIKE 'CUSTOMER#000000%' THEN 'customers-000' ELSE 'base' END AS profile_id
    FROM (SELECT c_custkey, CASE WHEN c_custkey%4<>0 THEN c_name END AS d FROM customer)""",
)
def j5(spark, sf):
    device_id = F.when(F.col("c_custkey") % 4 != 0, F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", lap_machine.resolve_profile(device_id, PROFILES).alias("profile_id"))


# ---- laps by geofence: twelve cars circling, one record per second ----

def lap_records(rows, *more):
    e = F.col("event_id")
    k, i = e % 12, F.floor(e / 12)
    angle = (i % (k + 50)) / (k + 50).cast("double") * F.lit(2 * math.pi)
    kind = F.when(i % 400 == 5, "anchor").when(i % 3 == 1, "imu").otherwise("gps")
    at_line = F.col("kind") == "anchor"
    base = rows.select(
        F.concat(F.lit("car"), k, F.lit(":d")).alias("session_key"), (i * 1000).alias("t_ms"), kind.alias("kind"), e.alias("seq"),
        (F.lit(40.0) + F.lit(0.001) * F.sin(angle)).alias("lat"), (F.lit(-111.0) + F.lit(0.001) * F.cos(angle)).alias("lon"),
        F.when(e % 5 != 0, F.col("value")).alias("speed"),
        (F.lit(9.8) + F.when(i % 400 > 60, 3.0).otherwise(0.0) + e % 7 / F.lit(10.0)).alias("magnitude"), *more,
    )
    return base.select(
        "session_key", "t_ms", "kind", "seq", F.when(at_line, 40.0).otherwise(F.col("lat")).alias("lat"),
        F.when(at_line, -110.999).otherwise(F.col("lon")).alias("lon"), "speed", "magnitude", *more,
    )


def bearing_sql(a, b, c, d):
    return (f"((degrees(atan2(sin(radians({d}-({b})))*cos(radians({c})), cos(radians({a}))*sin(radians({c}))-sin(radians({a}))*cos(radians({c}))*cos(radians({d}-({b})))))+360.0e0)"
            f" - 360.0e0*floor((degrees(atan2(sin(radians({d}-({b})))*cos(radians({c})), cos(radians({a}))*sin(radians({c}))-sin(radians({a}))*cos(radians({c}))*cos(radians({d}-({b})))))+360.0e0)/360.0e0))")


_LAP_SQL = f"""WITH RECURSIVE
  b AS (SELECT 'car'||(event_id%12)||':d' AS session_key, event_id//12 AS i, event_id AS seq, event_id%12+50 AS per, value, CASE WHEN event_id//12%400=5 THEN 'anchor' WHEN event_id//12%3=1 THEN 'imu' ELSE 'gps' END AS kind FROM events),
  r AS (SELECT session_key, i*1000 AS t, seq, kind, CASE WHEN kind='anchor' THEN 40.0e0 ELSE 40.0e0+0.001e0*sin((i%per)/CAST(per AS DOUBLE)*{2 * math.pi!r}) END AS lat,
      CASE WHEN kind='anchor' THEN -110.999e0 ELSE -111.0e0+0.001e0*cos((i%per)/CAST(per AS DOUBLE)*{2 * math.pi!r}) END AS lon, CASE WHEN seq%5<>0 THEN value END AS speed,
      9.8e0+CASE WHEN i%400>60 THEN 3.0e0 ELSE 0.0e0 END+seq%7/10.0e0 AS mag FROM b),
  ep AS (SELECT *, sum(CASE WHEN kind='anchor' THEN 1 ELSE 0 END) OVER (PARTITION BY session_key ORDER BY t) AS epoch FROM r),
  im AS (SELECT *, row_number() OVER (PARTITION BY session_key, epoch ORDER BY t) AS n FROM ep WHERE kind='imu' AND epoch>0),
  bl AS (SELECT session_key, epoch, avg(mag) AS base FROM im WHERE n<=10 GROUP BY ALL),
  g0 AS (SELECT g.*, m.t AS mt, m.mag AS mm, m.n AS mn, base FROM (SELECT * FROM ep WHERE kind='gps' AND epoch>0) g ASOF JOIN im m ON g.session_key=m.session_key AND g.epoch=m.epoch AND g.t>=m.t JOIN bl ON bl.session_key=g.session_key AND bl.epoch=g.epoch),
  la AS (SELECT session_key, epoch, min(t) AS lt FROM g0 WHERE speed>=3 AND t-mt<=2000 AND mn>=10 AND abs(mm-base)>=2.5e0 GROUP BY ALL),
  gl AS (SELECT e.session_key, e.epoch, e.t, e.lat, e.lon, e.speed, lt, lag(e.lat) OVER w AS plat, lag(e.lon) OVER w AS plon FROM ep e JOIN la ON la.session_key=e.session_key AND la.epoch=e.epoch WHERE e.kind='gps' AND e.t>=lt WINDOW w AS (PARTITION BY e.session_key, e.epoch ORDER BY e.t)),
  lb AS (SELECT session_key, epoch, {bearing_sql('40.0e0', '-110.999e0', 'lat', 'lon')} AS ab, speed AS lspeed FROM gl WHERE t=lt),
  mv AS (SELECT gl.*, ab, lspeed, {hav_sql('plat', 'plon', 'lat', 'lon')} AS step, {hav_sql('lat', 'lon', '40.0e0', '-110.999e0')} AS da, abs({bearing_sql('plat', 'plon', 'lat', 'lon')}-ab) AS bd FROM gl JOIN lb USING (session_key, epoch) WHERE t>lt),
  ca AS (SELECT session_key, epoch, t, lt FROM mv WHERE da<=40 AND least(bd, 360-bd)<=35),
  cr AS (SELECT session_key, epoch, 1 AS lap, lt AS t0, (SELECT min(c.t) FROM ca c WHERE c.session_key=la.session_key AND c.epoch=la.epoch AND c.t>=lt+30000) AS t1 FROM la
      UNION ALL SELECT session_key, epoch, lap+1, t1, (SELECT min(c.t) FROM ca c WHERE c.session_key=cr.session_key AND c.epoch=cr.epoch AND c.t>=t1+30000) FROM cr WHERE t1 IS NOT NULL)"""


@query(
    "st2_geofence_laps",
    f"""{_LAP_SQL}, done AS (SELECT * FROM cr WHERE t1 IS NOT NULL), agg AS (SELECT d.session_key, d.epoch, d.lap, d.t0, d.t1, sum(step) AS dist, count(*) AS n, max(mv.speed) AS top FROM done d JOIN mv ON mv.session_key=d.session_key AND mv.epoch=d.epoch AND mv.t>d.t0 AND mv.t<=d.t1 GROUP BY ALL),
    fin AS (SELECT a.*, gl.speed AS s0 FROM agg a JOIN gl ON gl.session_key=a.session_key AND gl.epoch=a.epoch AND gl.t=a.t0)
    SELECT session_key, CAST(epoch AS BIGINT) AS epoch, CAST(lap AS BIGINT) AS lap_number, t0 AS lap_start_ms, t1 AS lap_end_ms, t1-t0 AS lap_time_ms, coalesce(greatest(top, s0), 0) AS max_speed_kph,
    floor((dist/1000)/((t1-t0)/3600000.0e0)*10+0.5e0)/10 AS avg_speed_kph, floor(dist*10+0.5e0)/10 AS distance_m, n + CASE WHEN lap=1 THEN 1 ELSE 0 END AS gps_point_count FROM fin""",
)
def st2(spark, sf):
    out = lap_machine.laps(lap_records(events(spark, sf)), lap_machine.Profile(), 120_000)
    return out.drop("anchor_lat", "anchor_lon", "profile_id")


# ---- device sequences ----

def device_lines(spark, sf):
    e = F.col("event_id")
    n = F.floor(e / 3)
    return events(spark, sf).select(
        F.concat(F.lit("link"), n % 4).alias("link"), n.alias("notification"), e.alias("line"),
        (n * 40 + n * 7 % 13 + F.floor(n / 500) * 25_000).alias("received_ms"), ((e * 13 + e * e % 5 + F.floor(n / 500) * 777 + F.when(e % 211 == 0, 90).otherwise(0)) % 65_536).alias("counter"),
    )


_LINES = """
  li AS (SELECT 'link'||(event_id//3%4) AS link, event_id//3 AS nt, event_id AS line, event_id//3*40 + event_id//3*7%13 + event_id//3//500*25000 AS recv,
      (event_id*13 + event_id*event_id%5 + event_id//3//500*777 + CASE WHEN event_id%211=0 THEN 90 ELSE 0 END)%65536 AS counter FROM events),
  l1 AS (SELECT *, max(recv) OVER (PARTITION BY link ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heard, lag(counter) OVER (PARTITION BY link ORDER BY line) AS pc FROM li),
  l2 AS (SELECT *, heard IS NULL OR recv-heard>20000 AS rs FROM l1),
  l3 AS (SELECT *, sum(CASE WHEN rs THEN 1 ELSE 0 END) OVER (PARTITION BY link ORDER BY line) AS run, CASE WHEN rs THEN 0 ELSE (counter-pc+32768+65536)%65536-32768 END AS step FROM l2),
  l4 AS (SELECT *, sum(step) OVER (PARTITION BY link, run ORDER BY line) AS d FROM l3),
  l5 AS (SELECT *, max(d) OVER (PARTITION BY link, run ORDER BY line) AS pk FROM l4),
  l6 AS (SELECT *, pk*0.001e0 + min(recv - d - pk*0.001e0) OVER (PARTITION BY link, run ORDER BY line) AS off FROM l5),
  l7 AS (SELECT *, CAST(d + trunc(arg_max(off, line) OVER (PARTITION BY link, run, nt)) AS BIGINT) AS placed FROM l6)"""


@query("w17_clock_alignment", f"WITH {_LINES} SELECT line, CAST(run AS BIGINT) AS clock_run, CAST(d AS BIGINT) AS device_ms, placed AS placed_ms FROM l7")
def w17(spark, sf):
    return device.align_clock(device_lines(spark, sf), ["link"], ["line"], 2_000).select("line", "clock_run", "device_ms", "placed_ms")


@query(
    "w18_imu_gaps",
    """WITH li AS (SELECT 'link'||(event_id//3%4) AS link, event_id AS line, event_id*13 + event_id%37 AS placed, CASE WHEN event_id%10<>0 THEN (event_id*13 + event_id*event_id%5)%65536 END AS counter FROM events),
    l1 AS (SELECT *, lag(counter) OVER w AS pc, lag(placed) OVER w AS pp FROM li WHERE counter IS NOT NULL WINDOW w AS (PARTITION BY link ORDER BY line)),
    l2 AS (SELECT *, (counter-pc+32768+65536)%65536-32768 AS st, placed-pp AS ps FROM l1)
    SELECT link, line, CASE WHEN st>100 THEN 'gap' ELSE 'clock_jump' END AS event, st AS device_step_ms, CASE WHEN st<=100 THEN ps END AS placed_step_ms FROM l2 WHERE st>100 OR abs(ps-st)>10""",
)
def w18(spark, sf):
    e = F.col("event_id")
    rows = events(spark, sf).select(
        F.concat(F.lit("link"), F.floor(e / 3) % 4).alias("link"), e.alias("line"), (e * 13 + e % 37).alias("placed_ms"),
        F.when(e % 10 != 0, (e * 13 + e * e % 5) % 65_536).alias("counter"))
    return device.imu_gaps(rows, ["link"], ["line"], 2_000, gap_ms=100).select("link", "line", "event", "device_step_ms", "placed_step_ms")


def imu_samples(spark, sf):
    e = F.col("event_id")
    return events(spark, sf).where(e % 50 > 4).select(
        F.concat(F.lit("d"), e % 2).alias("device"), (e * 11 + F.when(F.floor(e / 400) % 3 == 0, e % 9 * 30).otherwise(0)).alias("t_ms"), "event_id", F.col("value").alias("ax"))


_GRID50 = """
  sm AS (SELECT 'd'||(event_id%2) AS device, event_id*11 + CASE WHEN event_id//400%3=0 THEN event_id%9*30 ELSE 0 END AS t, event_id, value AS ax FROM events WHERE event_id%50>4),
  sc AS (SELECT *, t - t%1000 AS sec FROM sm),
  gp AS (SELECT device, sec, i, sec+i*20 AS gt FROM (SELECT DISTINCT device, sec FROM sc), range(50) r(i)),
  nr AS (SELECT gp.*, arg_min(ax, (abs(t-gt), t, CASE WHEN t<gt THEN -event_id ELSE event_id END)) AS ax, min(abs(t-gt)) AS gap FROM gp JOIN sc USING (device, sec) GROUP BY ALL),
  ms AS (SELECT device, sec, count(*) FILTER (WHERE gap>20) AS missing FROM nr GROUP BY 1,2)"""


@query("w19_imu_grid", f"WITH {_GRID50} SELECT device, gt AS t_ms, ax, gap>20 AS missing FROM nr JOIN ms USING (device, sec) WHERE ms.missing<=25")
def w19(spark, sf):
    grid, _ = device.resample_imu(imu_samples(spark, sf), ["device"], ["ax"], "event_id")
    return grid.select("device", "t_ms", F.col("sample.ax").alias("ax"), "missing")


@query(
    "w19_imu_seconds",
    f"""WITH {_GRID50}, gp2 AS (SELECT device, sec, t-sec AS o, t-sec-lag(t-sec,1,0) OVER (PARTITION BY device, sec ORDER BY t, event_id) AS g FROM sc)
    SELECT device, sec AS second_ms, count(*) AS samples, greatest(max(g), 1000-max(o)) AS max_gap_ms, any_value(missing) AS missing_points FROM gp2 JOIN ms USING (device, sec) GROUP BY 1,2""",
)
def w19s(spark, sf):
    _, seconds = device.resample_imu(imu_samples(spark, sf), ["device"], ["ax"], "event_id")
    return seconds.select("device", "second_ms", "samples", "max_gap_ms", "missing_points")
