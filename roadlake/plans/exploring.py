"""Queries over unknown CAN traffic, duplicates, map elements, the archive and the binary log."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlake.operators import discovery, inventory, osm
from roadlake.operators.ordered import DAY_US
from roadlake.plans.registry import q4, query, s4
from roadlake.plans.views import events, table, v_can
from roadlake.sources import archive, can_log
from roadlake.streaming.run import work_dir

ORDER = ["t_ms", "seq"]
SESSION = ["session", "device"]
SEARCH = discovery.Search()

# ---- inventory over the CAN view ----


def id_frames(spark, sf):
    return v_can(spark, sf).select(
        *SESSION, "can_id", F.floor(F.col("t_us") / 1000).alias("t_ms"), "seq", (F.lit(8) - F.col("seq") % 3).alias("dlc"), "data_hex")


@query(
    "a10_id_inventory",
    f"""WITH f AS (SELECT session, device, can_id, t_us//1000 AS t, seq, 8-seq%3 AS dlc FROM v_can),
    sp AS (SELECT session, device, (max(t)-min(t))/1000.0e0 AS dur FROM f GROUP BY 1,2),
    md AS (SELECT session, device, can_id, arg_max(dlc,(n,dlc)) AS dlc, CAST(sum(n) AS BIGINT) AS n FROM (SELECT session, device, can_id, dlc, count(*) AS n FROM f GROUP BY ALL) GROUP BY 1,2,3),
    pe AS (SELECT session, device, can_id, t-lag(t) OVER (PARTITION BY session, device, can_id ORDER BY t, seq) AS p FROM f),
    me AS (SELECT session, device, can_id, list_sort(list(p))[count(*)//2+1] AS m FROM pe WHERE p IS NOT NULL GROUP BY ALL)
    SELECT md.session, md.device, md.can_id, n AS count, {s4('CASE WHEN dur>0 THEN n/dur ELSE 0.0e0 END')} AS rate_hz, CAST(m AS DOUBLE) AS median_period_ms, dlc FROM md JOIN sp USING (session, device) LEFT JOIN me ON me.session=md.session AND me.device=md.device AND me.can_id=md.can_id""",
    ("v_can",),
)
def a10(spark, sf):
    out = inventory.id_inventory(inventory.with_words(id_frames(spark, sf), ORDER, 50_000_000), 10_000_000)
    return out.withColumn("rate_hz", q4(F.col("rate_hz"))).withColumn("dlc", F.col("dlc").cast("long"))


# ---- three drives with a planted speed field ----


def _curve(t):
    return F.lit(60.0) + F.lit(40.0) * F.sin(t / 15.0) + F.lit(15.0) * F.sin(t / 4.7)


_CURVE = "60.0e0+40.0e0*sin({t}/15.0e0)+15.0e0*sin({t}/4.7e0)"


def planted(spark, sf):
    e = F.col("event_id")
    i = F.floor(e / 3)
    t = i * F.lit(0.15)

    def hexed(value, digits):
        return F.lpad(F.lower(F.hex(value.cast("long"))), digits, "0")

    noise = hexed((F.col("value") * 100) % 65536, 4)
    speed = F.concat(noise, hexed(i % 256, 2), hexed(F.floor(_curve(t - 0.4) * 100), 4), F.lit("000000"))
    other = F.concat(F.lit("00112233"), hexed(i % 16 + 64, 2), noise, F.lit("ff"))
    return events(spark, sf).select(
        F.concat(F.lit("v"), e % 3).alias("session"), F.lit("phone").alias("device"), (i * 150).alias("t_ms"), e.alias("seq"),
        F.when(i % 2 == 0, 256).otherwise(257).cast("long").alias("can_id"), F.lit(8).cast("long").alias("dlc"), F.when(i % 2 == 0, speed).otherwise(other).alias("data_hex"),
    )


def references(spark, sf):
    e = F.col("event_id")
    i = F.floor(e / 3)
    t = i * F.lit(0.15)
    base = events(spark, sf).select(
        F.concat(F.lit("v"), e % 3).alias("session"), F.lit("phone").alias("device"), (i * 150).alias("t_ms"), e.alias("seq"), i.alias("i"),
        _curve(t).alias("speed_kph"), (F.lit(5.0) * F.sin(t / 3.0)).alias("x"), (F.lit(20.0) * F.cos(t / 9.0)).alias("y"), (e % 3).cast("double").alias("z"))
    return (base.where("i % 7 = 0").select(*SESSION, "t_ms", "seq", "speed_kph"), base.where("i % 2 = 1").select(*SESSION, "t_ms", "seq", "x", "y", "z"))


_PLANTED = f"""
  ev AS (SELECT 'v'||(event_id%3) AS session, event_id//3 AS i, event_id//3*150 AS t, event_id AS seq, value, event_id//3*0.15e0 AS ts FROM events),
  fr AS (SELECT session, i, t, seq, CAST(CASE WHEN i%2=0 THEN 256 ELSE 257 END AS BIGINT) AS can_id, printf('%04x', CAST(trunc((value*100)%65536) AS BIGINT)) AS noise,
      CAST(floor(({_CURVE.format(t='(ts-0.4e0)')})*100) AS BIGINT) AS raw FROM ev),
  hx AS (SELECT *, CASE WHEN can_id=256 THEN noise||printf('%02x', i%256)||printf('%04x', raw)||'000000' ELSE '00112233'||printf('%02x', i%16+64)||noise||'ff' END AS data FROM fr),
  by_ AS (SELECT session, can_id, t, seq, b, CAST('0x'||substr(data, CAST(b AS INTEGER)*2+1, 2) AS BIGINT) AS v FROM hx, range(8) r(b)),
  st AS (SELECT *, lag(v) OVER (PARTITION BY session, can_id, b ORDER BY t, seq) AS pv FROM by_),
  gp AS (SELECT session, t, {_CURVE.format(t='ts')} AS v FROM ev WHERE i%7=0),
  gy AS (SELECT session, t, 5.0e0*sin(ts/3.0e0) AS x, 20.0e0*cos(ts/9.0e0) AS y, CAST(seq%3 AS DOUBLE) AS z FROM ev WHERE i%2=1)"""


@query(
    "a11_byte_class",
    f"""WITH {_PLANTED}, s8 AS (SELECT session, can_id, b, (v-pv)&255 AS s, count(*) AS n FROM st WHERE pv IS NOT NULL GROUP BY ALL), s4 AS (SELECT session, can_id, b, (v-pv)&15 AS s, count(*) AS n FROM st WHERE pv IS NOT NULL GROUP BY ALL),
    t8 AS (SELECT session, can_id, b, arg_max(s,(n,s)) AS top, max(n) AS n FROM s8 GROUP BY ALL), t4 AS (SELECT session, can_id, b, arg_max(s,(n,s)) AS top, max(n) AS n FROM s4 GROUP BY ALL),
    bb AS (SELECT session, can_id, b, count(DISTINCT v) AS d, min(v) AS lo, max(v) AS hi, count(*) AS c FROM by_ GROUP BY ALL)
    SELECT bb.session, bb.can_id, CAST(bb.b AS INTEGER) AS byte, CASE WHEN d<=1 THEN 'constant' WHEN c>=8 AND ((t8.top<>0 AND t8.n*10>=(c-1)*9) OR (t4.top<>0 AND t4.n*10>=(c-1)*9)) THEN 'counter' ELSE 'varying' END AS class, d AS "distinct", lo AS "min", hi AS "max"
    FROM bb JOIN t8 ON t8.session=bb.session AND t8.can_id=bb.can_id AND t8.b=bb.b JOIN t4 ON t4.session=bb.session AND t4.can_id=bb.can_id AND t4.b=bb.b""",
)
def a11(spark, sf):
    words = inventory.with_words(planted(spark, sf), ORDER, 60_000)
    return inventory.byte_inventory(words, inventory.id_inventory(words)).drop("device")


@query(
    "a10_bit_inventory",
    f"""WITH {_PLANTED}, bt AS (SELECT session, can_id, b*8+k AS bit, (v>>CAST(k AS INTEGER))&1 AS o, (xor(v,pv)>>CAST(k AS INTEGER))&1 AS x FROM st, range(8) q(k)),
    g AS (SELECT session, can_id, bit, count(*) AS n, sum(o)/CAST(count(*) AS DOUBLE) AS p, coalesce(sum(x),0) AS f FROM bt GROUP BY ALL)
    SELECT session, can_id, CAST(bit AS INTEGER) AS bit, floor(f/CAST(greatest(n-1,1) AS DOUBLE)*1000+0.5e0)/1000 AS flip_rate, floor((CASE WHEN p<=0 OR p>=1 THEN 0.0e0 ELSE -(p*log2(p)+(1-p)*log2(1-p)) END)*1000+0.5e0)/1000 AS entropy FROM g""",
)
def a10_bits(spark, sf):
    words = inventory.with_words(planted(spark, sf), ORDER, 60_000)
    return inventory.bit_inventory(words, inventory.id_inventory(words)).drop("device")


_REFS = _PLANTED + """,
  ac AS (SELECT session, (t+lag(t) OVER w)//2 AS t, (v-lag(v) OVER w)/3.6e0/((t-lag(t) OVER w)/1000.0e0) AS v, t-lag(t) OVER w AS dt FROM gp WINDOW w AS (PARTITION BY session ORDER BY t)),
  ya AS (SELECT session, CASE WHEN var_pop(z)>=var_pop(y) AND var_pop(z)>=var_pop(x) THEN 'z' WHEN var_pop(y)>=var_pop(x) THEN 'y' ELSE 'x' END AS axis FROM gy GROUP BY 1),
  yw AS (SELECT gy.session, t, CASE axis WHEN 'x' THEN x WHEN 'y' THEN y ELSE z END AS w FROM gy JOIN ya USING (session)),
  y1 AS (SELECT yw.*, g.t AS ta, g.v AS va FROM yw ASOF LEFT JOIN gp g ON yw.session=g.session AND yw.t>=g.t),
  y2 AS (SELECT y1.*, g.t AS tb, g.v AS vb FROM y1 ASOF LEFT JOIN gp g ON y1.session=g.session AND y1.t<g.t),
  rf AS (SELECT session, 'speed_kph' AS channel, t, v FROM gp UNION ALL SELECT session, 'long_accel_m_s2', t, v FROM ac WHERE dt>0 AND dt<=5000 UNION ALL SELECT session, 'yaw_rate_deg_s', t, w FROM yw
    UNION ALL SELECT session, 'lat_accel_m_s2', t, CASE WHEN ta IS NULL THEN vb WHEN tb IS NULL THEN va ELSE va+(t-ta)/(tb-ta)*(vb-va) END/3.6e0*radians(w) FROM y2)"""


@query("w16_reference_channels", f"WITH {_REFS} SELECT session, channel, CAST(t AS BIGINT) AS t_ms, {s4('v')} AS value FROM rf")
def w16(spark, sf):
    out = discovery.reference_channels(*references(spark, sf))
    return out.select("session", "channel", "t_ms", q4(F.col("value")).alias("value"))


_CORR = _REFS + """,
  fb AS (SELECT session, can_id, min(t) AS f0, max(t) AS f1 FROM hx GROUP BY ALL), rb AS (SELECT session, channel, min(t) AS r0, max(t) AS r1 FROM rf GROUP BY ALL),
  pr AS (SELECT session, can_id, channel, greatest(f0,r0) AS t0, (least(f1,r1)-greatest(f0,r0))//200 AS n FROM fb JOIN rb USING (session)),
  gd AS (SELECT session, can_id, channel, i, t0+i*200 AS t FROM pr, LATERAL (SELECT unnest(range(0, n+1)) AS i)),
  h1 AS (SELECT gd.*, h.data FROM gd ASOF JOIN hx h ON gd.session=h.session AND gd.can_id=h.can_id AND gd.t>=h.t),
  h2 AS (SELECT h1.*, g.t AS ta, g.v AS va FROM h1 ASOF LEFT JOIN rf g ON h1.session=g.session AND h1.channel=g.channel AND h1.t>=g.t),
  h3 AS (SELECT h2.*, g.t AS tb, g.v AS vb FROM h2 ASOF LEFT JOIN rf g ON h2.session=g.session AND h2.channel=g.channel AND h2.t<g.t),
  gr AS MATERIALIZED (SELECT session, can_id, channel, i, CAST('0x'||data AS UBIGINT) AS be, CAST('0x'||substr(data,15,2)||substr(data,13,2)||substr(data,11,2)||substr(data,9,2)||substr(data,7,2)||substr(data,5,2)||substr(data,3,2)||substr(data,1,2) AS UBIGINT) AS le,
      CASE WHEN ta IS NULL THEN vb WHEN tb IS NULL THEN va ELSE va+(t-ta)/(tb-ta)*(vb-va) END AS ref FROM h3),
  fi AS (SELECT true AS little_endian, s AS start, s AS sh, l AS length FROM range(0, 64) r(s), (VALUES (8),(12),(16)) q(l) WHERE s+l<=64 UNION ALL SELECT false, s, 64-(s//8*8+7-s%8)-l, l FROM range(0, 64) r(s), (VALUES (8),(12),(16)) q(l) WHERE s//8*8+7-s%8+l<=64),
  rw AS (SELECT session, can_id, channel, i, little_endian, start, length, CAST((CASE WHEN little_endian THEN le ELSE be END >> CAST(sh AS UBIGINT)) & CAST((1<<length)-1 AS UBIGINT) AS BIGINT) AS u FROM gr, fi),
  vr AS (SELECT session, can_id, channel, little_endian, start, length FROM rw GROUP BY ALL HAVING var_pop(u)>=1e-9),
  sg AS (SELECT rw.*, s.signed, CAST(CASE WHEN s.signed AND u>=(1<<(length-1)) THEN u-(1<<length) ELSE u END AS DOUBLE) AS x FROM rw JOIN vr USING (session, can_id, channel, little_endian, start, length), (VALUES (false),(true)) s(signed)),
  lg AS MATERIALIZED (SELECT session, can_id, channel, gr.i-l AS i, l, ref FROM gr, range(-10, 11) q(l)),
  cc AS (SELECT sg.session, sg.can_id, sg.channel, little_endian, start, length, signed, l AS lag, corr(lg.ref, x) AS r, regr_slope(lg.ref, x) AS factor, regr_intercept(lg.ref, x) AS off, count(*) AS n
      FROM sg JOIN lg ON lg.session=sg.session AND lg.can_id=sg.can_id AND lg.channel=sg.channel AND lg.i=sg.i GROUP BY ALL),
  bs AS (SELECT * FROM cc WHERE NOT isnan(r) AND r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY session, can_id, channel, little_endian, start, length, signed ORDER BY abs(r) DESC, lag)=1)"""


@query(
    "d1_field_correlation",
    f"""WITH {_CORR} SELECT session, can_id, channel, little_endian, CAST(start AS INTEGER) AS start, CAST(length AS INTEGER) AS length, signed, {s4('r')} AS r, lag*200 AS lag_ms, {s4('factor*1000')} AS factor_e3, n AS samples FROM bs WHERE abs(r)>=0.8e0 AND n>=5""",
)
def d1(spark, sf):
    frames = planted(spark, sf)
    gps, gyro = references(spark, sf)
    words = inventory.with_words(frames, ORDER, 60_000)
    ids = inventory.id_inventory(words)
    channels = discovery.reference_channels(gps, gyro)
    pairs = discovery.pair_status(words, ids, channels, SEARCH)
    found = discovery.correlate(pairs, words, channels, SEARCH)
    return found.select("session", "can_id", "channel", "little_endian", "start", "length", "signed", q4(F.col("r")).alias("r"), F.col("lag_ms").cast("long").alias("lag_ms"),
                        q4(F.col("factor") * 1000).alias("factor_e3"), "samples")


@query(
    "d2_session_analysis",
    f"""WITH {_CORR} SELECT pr.session, 'phone' AS device, pr.can_id, pr.channel, CASE WHEN ok.session IS NULL THEN 'NO_MATCH' ELSE 'OK' END AS status
    FROM pr LEFT JOIN (SELECT DISTINCT session, can_id, channel FROM bs WHERE abs(r)>=0.8e0 AND n>=5) ok ON ok.session=pr.session AND ok.can_id=pr.can_id AND ok.channel=pr.channel""",
)
def d2(spark, sf):
    gps, gyro = references(spark, sf)
    return discovery.analyse(planted(spark, sf), gps, gyro, SEARCH)["statuses"]


@query("t4_top_candidates")
def t4(spark, sf):
    gps, gyro = references(spark, sf)
    return discovery.analyse(planted(spark, sf), gps, gyro, SEARCH)["candidates"]


# ---- duplicates ----


def bus_messages(spark, sf):
    base = v_can(spark, sf).select("session", "base_us", "can_id", "dt_us", "data_hex", "seq", F.explode(F.sequence(F.lit(0), F.col("seq") % 3)).alias("copy"))
    apart = F.when(F.col("seq") % 2 == 0, F.col("copy")).otherwise(F.col("copy") * 3_000_000)
    return base.select("session", "base_us", "can_id", "dt_us", "data_hex", (F.col("seq") * 10 + apart).alias("position"))


_BUS = """
  ms AS (SELECT session, base_us, can_id, dt_us, data_hex, seq*10 + CASE WHEN seq%2=0 THEN c ELSE c*3000000 END AS pos FROM v_can, range(3) r(c) WHERE c<=seq%3),
  cp AS (SELECT session, base_us, can_id, dt_us, data_hex, count(*) AS copies FROM ms GROUP BY ALL)"""


@query("a15_duplicate_share", f"WITH {_BUS} SELECT session, CAST(sum(copies) AS BIGINT) AS messages, count(*) AS distinct_messages, {s4('1-count(*)/CAST(sum(copies) AS DOUBLE)')} AS duplicate_share FROM cp GROUP BY 1", ("v_can",))
def a15(spark, sf):
    return inventory.duplicate_report(bus_messages(spark, sf)).withColumn("duplicate_share", q4(F.col("duplicate_share")))


@query("a15_copy_histogram", f"WITH {_BUS} SELECT session, copies, count(*) AS distinct_messages FROM cp GROUP BY 1, 2", ("v_can",))
def a15h(spark, sf):
    return inventory.copy_histogram(bus_messages(spark, sf))


@query("a15_copies_per_second", f"WITH {_BUS} SELECT session, base_us, CAST(sum(copies) AS BIGINT) AS messages, count(*) AS distinct_messages, CAST(median(copies) AS DOUBLE) AS median_copies FROM cp GROUP BY 1, 2", ("v_can",))
def a15s(spark, sf):
    return inventory.copies_per_second(bus_messages(spark, sf))


@query(
    "a15_repeat_order",
    f"""WITH {_BUS}, l AS (SELECT *, lag((can_id,dt_us,data_hex)) OVER (PARTITION BY session, base_us ORDER BY pos) AS p, min(pos) OVER (PARTITION BY session, base_us, can_id, dt_us, data_hex) AS f FROM ms)
    SELECT session, count(*) FILTER (WHERE coalesce(p=(can_id,dt_us,data_hex),false)) AS adjacent_pairs, count(*) FILTER (WHERE pos>f AND NOT coalesce(p=(can_id,dt_us,data_hex),false)) AS separate_repeats FROM l GROUP BY 1""",
    ("v_can",),
)
def a15o(spark, sf):
    return inventory.repeat_order(bus_messages(spark, sf), "position", 10_000_000)


@query(
    "a15_filled_share",
    f"""WITH f AS (SELECT 'c'||(o_custkey%50) AS session, CASE WHEN o_custkey%50<>7 THEN o_orderkey%100 ELSE 0 END AS imu, o_orderkey%100*(o_orderkey%4)//4 AS imu_missing FROM orders)
    SELECT session, CAST(sum(imu) AS BIGINT) AS imu_samples, CAST(sum(imu_missing) AS BIGINT) AS filled, {s4('sum(imu_missing)/nullif(CAST(sum(imu) AS DOUBLE), 0)')} AS filled_share FROM f GROUP BY 1""",
)
def a15f(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    frames = table(spark, sf, "orders").select(
        F.concat(F.lit("c"), c % 50).alias("session"), F.when(c % 50 != 7, k % 100).otherwise(0).alias("imu"), F.floor(k % 100 * (k % 4) / 4).alias("imu_missing"))
    return inventory.filled_share(frames).withColumn("filled_share", q4(F.col("filled_share")))


# ---- map elements: a way per order, relations per customer ----


def ways(spark, sf):
    k = F.col("o_orderkey")
    first = F.floor(k / 5) * 10 + k % 5 + F.when(k % 11 == 0, 100_000_000).otherwise(0)
    name = F.when(k % 3 == 0, F.concat(F.lit("Circuit "), k % 40)).when(k % 17 == 0, "Pit Lane").when(k % 19 == 0, "")
    at = F.transform(F.array(first, first + 1), lambda n: F.struct((n / 1e6).alias("lat"), (-n / 1e6).alias("lon")))
    return table(spark, sf, "orders").select(k.alias("way_id"), name.alias("name"), F.array(first, first + 1).alias("nodes"), F.when(k % 4 == 1, F.reverse(at)).otherwise(at).alias("line"))


def relations(spark, sf):
    c = F.col("c_custkey")

    def member(kind, ref, role):
        return F.struct(F.lit(kind).alias("type"), ref.cast("long").alias("ref"), F.lit(role).alias("role"))

    return table(spark, sf, "customer").select(
        c.alias("relation_id"), F.when(c % 2 == 0, F.concat(F.lit("Ring "), c)).alias("name"), F.when(c % 3 == 0, F.lit("Alt")).alias("alt_name"),
        F.array(member("way", c * 7, ""), member("way", c * 7 + 1, "pit_lane"), member("node", c * 7 + 2, ""), member("way", c * 7 + 1_000_000, "")).alias("members"))


_OSM = """
  wy AS (SELECT o_orderkey AS w, CASE WHEN o_orderkey%3=0 THEN 'Circuit '||(o_orderkey%40) WHEN o_orderkey%17=0 THEN 'Pit Lane' END AS name, o_orderkey//5*10+o_orderkey%5+CASE WHEN o_orderkey%11=0 THEN 100000000 ELSE 0 END AS n0 FROM orders),
  mb AS (SELECT c_custkey AS rel, CASE WHEN c_custkey%2=0 THEN 'Ring '||c_custkey WHEN c_custkey%3=0 THEN 'Alt' ELSE 'OSM Relation '||c_custkey END AS name, c_custkey*7 AS w FROM customer WHERE c_custkey*7 IN (SELECT w FROM wy)),
  un AS (SELECT * FROM wy WHERE name IS NULL AND w NOT IN (SELECT w FROM mb)),
  eg AS (SELECT a.w AS a, b.w AS b FROM un a JOIN un b ON b.n0 IN (a.n0-1, a.n0, a.n0+1)),
  rc AS (SELECT w AS a, w AS b FROM un UNION SELECT rc.a, eg.b FROM rc JOIN eg ON eg.a=rc.b),
  cm AS (SELECT a AS w, min(b) AS c FROM rc GROUP BY 1)"""
_CAND = _OSM + """,
  cd AS (SELECT 'relation:'||rel AS candidate, name, rel AS relation_id, w AS way_id FROM mb UNION ALL SELECT 'name:'||name, name, NULL, w FROM wy WHERE name IS NOT NULL AND lower(name) NOT LIKE '%pit%' AND w NOT IN (SELECT w FROM mb)
    UNION ALL SELECT 'unnamed:'||c, 'Unnamed track', NULL, w FROM cm)"""


@query("d4_connected_ways", f"WITH RECURSIVE {_OSM} SELECT w AS way_id, c AS component FROM cm")
def d4(spark, sf):
    alone = ways(spark, sf).where(F.nullif(F.col("name"), F.lit("")).isNull())
    members = relations(spark, sf).select(F.explode("members").alias("m")).where("m.type = 'way' AND m.role <> 'pit_lane'").select(F.col("m.ref").alias("way_id"))
    return osm.connected_ways(alone.join(members, "way_id", "left_anti").select("way_id", F.explode("nodes").alias("node_id")))


@query("d3_track_candidates", f"WITH RECURSIVE {_CAND} SELECT candidate, name, relation_id, way_id FROM cd")
def d3(spark, sf):
    return osm.track_candidates(relations(spark, sf), ways(spark, sf))


def known_tracks(spark, sf):
    s = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(F.when(s % 2 == 0, s * 5).alias("relation_id"), F.when(s % 2 == 1, F.array(s * 13, s * 13 + 1)).alias("way_ids"))


_CHECK = _CAND + """,
  kt AS (SELECT CASE WHEN s_suppkey%2=0 THEN s_suppkey*5 END AS rel, CASE WHEN s_suppkey%2=1 THEN s_suppkey*13 END AS w0 FROM supplier),
  ck AS (SELECT candidate, name, relation_id, bool_or(relation_id IS NOT NULL AND relation_id IN (SELECT rel FROM kt WHERE rel IS NOT NULL)) AS isrel,
      list_sort(list(DISTINCT way_id) FILTER (WHERE relation_id IS NULL AND way_id IN (SELECT w0 FROM kt WHERE w0 IS NOT NULL UNION SELECT w0+1 FROM kt WHERE w0 IS NOT NULL))) AS hit FROM cd GROUP BY ALL)"""
_REASON = "CASE WHEN isrel THEN 'OSM relation '||relation_id||' already imported' WHEN len(hit)>0 THEN 'Way IDs ['||array_to_string(hit, ', ')||'] already imported' END"


@query("d6_import_check", f"WITH RECURSIVE {_CHECK} SELECT candidate, name, relation_id, {_REASON} AS reason FROM ck")
def d6(spark, sf):
    return osm.import_check(d3(spark, sf), known_tracks(spark, sf)).drop("already_imported")


@query("j15_already_imported", f"WITH RECURSIVE {_CHECK} SELECT candidate, {_REASON} IS NOT NULL AS already_imported FROM ck")
def j15(spark, sf):
    return osm.import_check(d3(spark, sf), known_tracks(spark, sf)).select("candidate", "already_imported")


@query(
    "d5_stitched_lines",
    f"""WITH RECURSIVE {_CAND},
  wn AS (SELECT DISTINCT candidate, way_id, n0, o.way_id%4=1 AS back FROM cd o JOIN wy ON wy.w=o.way_id),
  nd AS (SELECT candidate, n, count(*) AS met FROM (SELECT candidate, n0 AS n FROM wn UNION ALL SELECT candidate, n0+1 FROM wn) GROUP BY 1, 2),
  st AS (SELECT wn.*, CASE WHEN met=2 AND lag(n0) OVER w = n0-1 THEN 0 ELSE 1 END AS starts FROM wn JOIN nd ON nd.candidate=wn.candidate AND nd.n=wn.n0 WINDOW w AS (PARTITION BY wn.candidate ORDER BY n0)),
  ln AS (SELECT *, sum(starts) OVER (PARTITION BY candidate ORDER BY n0) AS line FROM st),
  ag AS (SELECT candidate, min(way_id) AS line_id, count(*) AS ways, count(*)+1 AS points, min(n0) AS lo, max(n0)+1 AS hi, arg_min(back, way_id) AS back FROM ln GROUP BY candidate, line)
  SELECT candidate, line_id, ways, points, CASE WHEN back THEN hi ELSE lo END/1e6 AS from_lat, -(CASE WHEN back THEN lo ELSE hi END)/1e6 AS to_lon FROM ag""",
)
def d5(spark, sf):
    points = osm.stitch(d3(spark, sf).join(ways(spark, sf).select("way_id", "line"), "way_id"))
    place = F.struct("rank", "point")
    return points.groupBy("candidate", "line_id").agg(
        (F.max("rank") + 1).alias("ways"), F.count("*").alias("points"), F.min_by("lat", place).alias("from_lat"), F.max_by("lon", place).alias("to_lon"))


# ---- archive and binary log ----


def messages(spark, sf):
    e = F.col("event_id")
    us = F.col("t_us") - F.when(e % 6 == 0, F.pmod("t_us", F.lit(1_000_000))).otherwise(0)
    iso = F.concat(F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    payload = F.to_json(F.struct(
        F.when(e % 8 != 0, F.concat(F.lit("d"), F.col("user_id") % 10)).alias("device_id"), F.concat(F.lit("u"), "user_id").alias("source_session"),
        F.when(e % 7 == 0, F.lit("not a time")).when(e % 5 != 0, iso).alias("captured_at"), F.when(e % 5 == 0, iso).alias("received_at"), F.col("event_type").alias("source")))
    return events(spark, sf).select(
        F.concat(F.lit("telemetry/raw "), "event_type").alias("topic"), F.create_map(F.lit("z"), F.lit("1"), F.lit("a"), F.col("event_type")).alias("headers"),
        payload.alias("payload_json"), (F.lit(1_710_000_000_000_000) + e * 1_000_000).alias("archived_us"), "event_id")


_ARCHIVE = """
  ar AS (SELECT event_id, event_type, user_id, epoch_us(ts) - CASE WHEN event_id%6=0 THEN epoch_us(ts)%1000000 ELSE 0 END AS us, 1710000000000000+event_id*1000000 AS au FROM events),
  an AS (SELECT *, CASE WHEN event_id%7=0 THEN au ELSE us END AS eu FROM ar)"""
_ISO = "strftime(make_timestamp({x}), '%Y-%m-%dT%H:%M:%S')||CASE WHEN {x}%1000000=0 THEN '' ELSE printf('.%06d', {x}%1000000) END||'Z'"


@query(
    "s12_archive_normalise",
    f"""WITH {_ARCHIVE} SELECT 'telemetry/raw '||event_type AS topic, CASE WHEN event_id%8<>0 THEN 'd'||(user_id%10) ELSE 'unknown-device' END AS device_id, 'u'||user_id AS source_session, strftime(make_timestamp(eu),'%Y-%m-%d') AS event_date,
    strftime(make_timestamp(eu),'%H') AS event_hour, {_ISO.format(x='eu')} AS event_timestamp, eu AS event_us, {_ISO.format(x='au')} AS archived_at, '{{"a":"'||event_type||'","z":"1"}}' AS headers_json, 'telemetry_raw_'||event_type AS part FROM an""",
)
def s12(spark, sf):
    out = archive.normalise(messages(spark, sf))
    return out.select("topic", "device_id", "source_session", "event_date", "event_hour", "event_timestamp", "event_us", "archived_at", "headers_json",
                      archive.path_part(F.col("topic")).alias("part"))


@query(
    "s13_session_replay",
    f"""WITH {_ARCHIVE}, sv AS (SELECT 'u'||user_id AS s, CASE WHEN event_id%8<>0 THEN 'd'||(user_id%10) ELSE 'unknown-device' END AS d, eu, event_type FROM an),
    st AS (SELECT s, d, max(eu) FILTER (WHERE event_type='signup') AS a FROM sv GROUP BY 1, 2)
    SELECT s AS source_session, d AS device_id, count(*) AS n, min(eu) AS first_us FROM sv JOIN st USING (s, d) WHERE eu>=a-300000000-5*86400000000 GROUP BY 1, 2""",
)
def s13(spark, sf):
    records = archive.normalise(messages(spark, sf))
    starts = records.where("source = 'signup'").groupBy("source_session", "device_id").agg((F.max("event_us") - 5 * DAY_US).alias("started_us"))
    return archive.replay_sessions(records, starts).groupBy("source_session", "device_id").agg(F.count("*").alias("n"), F.min("event_us").alias("first_us"))


@query(
    "s13_pruned_replay",
    """WITH sv AS (SELECT event_type, 'u'||(user_id%3) AS s, epoch_us(ts)//200 AS eu FROM events)
    SELECT 'telemetry_raw_'||event_type AS topic, count(*) AS n, min(eu) AS first_us FROM sv WHERE s='u1' AND eu>=(SELECT max(eu) FROM sv)-3600000000-300000000 GROUP BY 1""",
)
def s13_pruned(spark, sf):
    """The whole table, two hundredfold in time as recorded traffic is, is archived; one session's last hour is read back
    from its own partitions."""
    iso = F.date_format(F.timestamp_micros(F.floor(F.col("t_us") / 200)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    payload = F.to_json(F.struct(F.lit("d").alias("device_id"), F.concat(F.lit("u"), F.col("user_id") % 3).alias("source_session"), iso.alias("captured_at"), "value"))
    rows = events(spark, sf).select(F.concat(F.lit("telemetry/raw "), "event_type").alias("topic"), F.create_map(F.lit("a"), F.col("event_type")).alias("headers"), payload.alias("payload_json"), F.lit(0).cast("long").alias("archived_us"))
    records, folder = archive.normalise(rows), f"{work_dir(spark)}/archive"
    archive.write_archive(records, folder)
    started = records.agg(F.max("event_us")).first()[0] - 3_600_000_000
    return archive.replay_session(spark.read.parquet(folder), "u1", "d", started).groupBy("topic").agg(F.count("*").alias("n"), F.min("event_us").alias("first_us"))


@query(
    "s9_can_log",
    """SELECT session_no, count(*) AS frames, CAST(sum(timestamp_ms) AS BIGINT) AS total_ms, min(data_hex) AS first_hex, max(data_hex) AS last_hex FROM (SELECT can_id%1000 AS session_no, t_us//1000%4294967296 AS timestamp_ms, substr(data_hex,1,(CAST(seq AS INTEGER)%9)*2) AS data_hex FROM v_can) GROUP BY 1""",
    ("v_can",),
)
def s9(spark, sf):
    can = v_can(spark, sf)
    dlc = (F.col("seq") % 9).cast("int")
    frames = can.select((F.floor(F.col("t_us") / 1000) % 4_294_967_296).alias("timestamp_ms"), "can_id", dlc.alias("dlc"),
                        F.substring(F.col("data_hex"), F.lit(1), dlc * 2).alias("data_hex"), (F.col("can_id") > 515).alias("is_extended"))
    folder = work_dir(spark)
    can_log.write_can_log(frames, folder)
    log = can_log.read_can_log(spark, f"{folder}/*.bin")
    return log.groupBy((F.col("can_id") % 1000).alias("session_no")).agg(
        F.count("*").alias("frames"), F.sum("timestamp_ms").alias("total_ms"), F.min("data_hex").alias("first_hex"), F.max("data_hex").alias("last_hex"))
