"""Known answers: decode vectors, window statistics, replay of small logs, state, summaries, laps, discovery."""

import math
import struct

import pytest
from pyspark.sql import functions as F

from roadlake.functions.rounding import half_even
from roadlake.functions.text import glob_regex
from roadlake.operators import decode, device, discovery, inventory, laps, sessions, state, summary
from roadlake.operators.profile import decode_profile, signal_events
from roadlake.operators.windows import WindowConfig, aggregate
from roadlake.plans.replay import replay_log
from roadlake.sources import can_log
from roadlake.sources.dbc import parse_dbc

FRAMES = "session string, event_id long, timestamp_ms long, can_id long, dlc int, data_hex string"


def frames(spark, *rows):
    data = [("s", i, 1000 + i, c, len(h) // 2, h) for i, (c, h) in enumerate(rows)]
    return spark.createDataFrame(data, FRAMES)


def test_profile_vectors(spark):
    log = frames(spark, (0x0C9, "000fa0007f01"), (0x3E9, "1388"), (0x4C1, "0000785064"), (0x4D1, "00006e"), (0x1EF, "00003039"), (0x135, "04"))
    got = {r["signal"]: round(r["value"], 4) for r in signal_events(decode_profile(log)).collect()}
    assert got == {"EngineRPM": 1000.0, "ThrottlePosition": 49.8039, "BrakePedalApplied": 1.0, "VehicleSpeed": 50.0, "CoolantTemp": 80.0,
                   "IntakeAirTemp": 40.0, "AmbientTemp": 10.0, "EngineOilTemp": 70.0, "MassAirFlow": 123.45, "TransmissionGear": 4.0}


@pytest.mark.parametrize("frame, reason", [((0x0C9, "000fa0"), "DBC_DECODE_FAILED"), ((0x3E9, "ffff"), "RANGE_EXCEEDED"), ((0x123, "00"), "UNKNOWN_CAN_ID")])
def test_replay_of_one_bad_frame(spark, frame, reason):
    got = dict(replay_log(frames(spark, frame)).summary().collect())
    assert got[f"diagnostics.reasons.{reason}"] == 1
    assert got["validated_events"] == got["routed_events"] == got["aggregated_events"] == 0


def test_window_statistics_and_derived(spark):
    data = [("signals.powertrain", n, "u", "s", v, t * 1_000_000, i) for i, (n, v, t) in enumerate(
        [("EngineRPM", 1000.0, 0), ("EngineRPM", 1200.0, 1), ("VehicleSpeed", 40.0, 1), ("VehicleSpeed", 50.0, 2)])]
    routed = spark.createDataFrame(data, "topic string, signal string, unit string, session string, value double, t_us long, event_id long")
    out = {r["signal"]: r for r in aggregate(routed)[0].collect()}
    assert out["EngineRPM"]["mean_value"] == 1100 and out["EngineRPM"]["stddev_value"] == 100
    assert out["PowertrainLoadIndex"]["mean_value"] == 49_500 and out["PowertrainLoadIndex"]["sample_count"] == 2
    _, dropped = aggregate(routed, WindowConfig(min_samples={"EngineRPM": 3}, max_samples={"VehicleSpeed": 1}))
    assert {r["signal"]: r["reason"] for r in dropped.collect()} == {"EngineRPM": "INSUFFICIENT_SAMPLES", "VehicleSpeed": "WINDOW_OVERFLOW"}


def test_dbc_file_and_decode(spark):
    text = ['BO_ 201 Engine: 7 X', ' SG_ RPM : 15|16@0+ (0.25,0) [0|0] "rpm" X', 'BO_ 2418843648 Far: 2 X', ' SG_ A : 7|16@0- (1,0) [0|0] "" X']
    signals = parse_dbc(spark.createDataFrame([("d", i, line) for i, line in enumerate(text)], "dbc string, line_no int, line string"))
    assert {(r["signal"], r["can_id"]) for r in signals.collect()} == {("RPM", 201), ("A", 2418843648 & 0x1FFFFFFF)}
    raw = spark.createDataFrame([("d", 201, "840c6c07004000"), ("d", 201, "0f"), ("d", 2418843648 & 0x1FFFFFFF, "fffe")], "dbc string, can_id long, data_hex string")
    assert {r["signal"]: r["value"] for r in decode.decode(raw, signals).collect()} == {"RPM": 795.0, "A": -2.0}


@pytest.mark.parametrize("little_endian, signed", [(True, False), (True, True), (False, False), (False, True)])
def test_bit_fields_by_walk(spark, little_endian, signed):
    word = bytes([0x84, 0x0C, 0x6C, 0x97, 0xA5, 0x40, 0x13, 0xFE])
    cases = []
    for length in (1, 5, 8, 12, 16, 33, 64):
        for start in range(64):
            bits, pos = [], start
            for _ in range(length):
                bits.append(pos)
                pos = pos + 1 if little_endian else (pos + 15 if pos % 8 == 0 else pos - 1)
            if max(bits) >= 64:
                continue
            order = bits if little_endian else bits[::-1]
            raw = sum(((word[b // 8] >> (b % 8)) & 1) << i for i, b in enumerate(order))
            cases.append((start, length, float(raw - (1 << length) if signed and raw >> (length - 1) else raw)))
    table = spark.createDataFrame([("d", 1, "M", 8, f"{s}|{n}", s, n, little_endian, signed, 1.0, 0.0, "") for s, n, _ in cases],
                                  "dbc string, can_id long, message string, dlc int, signal string, start int, length int, little_endian boolean, signed boolean, scale double, offset double, unit string")
    raw = spark.createDataFrame([("d", 1, word.hex())], "dbc string, can_id long, data_hex string")
    got = {r["signal"]: r["value"] for r in decode.decode(raw, table).collect()}
    assert got == {f"{s}|{n}": v for s, n, v in cases}


def test_binary_log(spark, tmp_path):
    rows = [(5, 0x123, False, b"\x01\x02"), (6, 0x1ABCDEF0, True, b"\xff" * 8)]
    (tmp_path / "a.bin").write_bytes(b"".join(struct.pack(">IIB8s", t, i | (0x80000000 if x else 0), len(d), d) for t, i, x, d in rows))
    got = [(r["timestamp_ms"], r["can_id"], r["is_extended"], bytes.fromhex(r["data_hex"])) for r in can_log.read_can_log(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(rows)
    (tmp_path / "b.bin").write_bytes(b"x" * 18)
    with pytest.raises(ValueError, match="multiple of 17"):
        can_log.read_can_log(spark, str(tmp_path))


def test_rounding_matches_python(spark):
    values = [4.45, 4.25, 0.35, 2.675, 1.005, -4.45, -0.25, 1e6 + 0.05, 0.5, 1.5, 33.349999999999994]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 3):
        got = [r[0] for r in df.select(half_even(F.col("v"), digits)).collect()]
        assert got == [round(v, digits) for v in values]


def test_glob_regex():
    import re

    assert re.match(glob_regex("Engine*"), "EngineRPM") and not re.match(glob_regex("Engine*"), "MyEngine")
    assert re.match(glob_regex("a[!b]?"), "acd") and not re.match(glob_regex("a[!b]?"), "abd") and re.match(glob_regex("x.y"), "x.y") and not re.match(glob_regex("x.y"), "xzy")


def test_carry_and_last_value(spark):
    can = spark.createDataFrame([("s", "d", 0, 100_000, 1, "rpm", 1000.0), ("s", "d", 0, 900_000, 2, "rpm", 2000.0), ("s", "d", 0, 500_000, 3, "odo", 7.0), ("s", "d", 4_000_000, 4_200_000, 4, "rpm", 900.0)],
                                "session string, device string, base_us long, t_us long, seq long, signal string, value double")
    closed = spark.createDataFrame([("s", "d", 0, "complete"), ("s", "d", 3_000_000, "complete"), ("s", "d", 4_000_000, "incomplete")], "session string, device string, base_us long, status string")
    motion = spark.createDataFrame([], "session string, device string, base_us long, t_us long, seq long, fix struct<lat:double>, accel struct<x:double,y:double,z:double>, gyro struct<x:double,y:double,z:double>")
    rows = {r["base_us"]: r for r in state.vehicle_state(closed, can, motion, chunk=2_000_000).collect()}
    assert rows[0]["signals"] == {"rpm": 2000.0, "odo": 7.0} and rows[0]["carried"] == {}
    assert tuple(rows[0]["signal_stats"]["rpm"]) == (1000.0, 2000.0, 1500.0, 2)
    assert rows[3_000_000]["carried"] == {"rpm": 3100, "odo": 3500}
    assert rows[4_000_000]["signals"]["rpm"] == 900.0 and rows[4_000_000]["carried"] == {"odo": 4500} and not rows[4_000_000]["complete"]


def test_nearest_rank(spark):
    df = spark.createDataFrame([("a", i) for i in range(1, 21)], "k string, v long")
    got = summary.nearest_rank(df, ["k"], "v", {"p50": summary.at_share(0.5), "p95": summary.at_share(0.95)}, 6).first()
    assert (got["p50"], got["p95"], got["max"], got["n"]) == (10, 19, 20, 20)


@pytest.mark.parametrize("ended, expected, received, heard_min, state_, pct", [
    (True, 10, 10, 0, "complete", 100.0), (True, 10, 9, 0, "incomplete", 90.0), (False, None, 5, 1, "open", None), (False, None, 5, 31, "unterminated", None), (True, 0, 0, 0, "complete", 100.0)])
def test_session_states(spark, ended, expected, received, heard_min, state_, pct):
    now = 10**12
    row = spark.createDataFrame([(now if ended else None, expected, received, 0, now - heard_min * 60_000_000)],
                                "ended_us long, frames_expected long, frames_received long, started_us long, last_frame_received_us long")
    got = row.select(sessions.state(F.lit(now)), sessions.completeness_pct()).first()
    assert tuple(got) == (state_, pct)


def test_laps_by_wrap_and_delta(spark):
    def lap(session, seconds):
        return [(session, int(k * seconds / 10 * 1e6), k, k * 10.0, 60.0, 1, 100.0) for k in range(11)]

    cols = "session string, t_us long, event_id long, s_m double, speed double, track_id long, track_length_m double"
    numbered = laps.laps_of(spark.createDataFrame(lap("a", 20) + lap("b", 16), cols), ["t_us", "event_id"], chunk=3_000_000)
    elapsed = laps.elapsed_on_grid(numbered, ["t_us", "event_id"], 50.0, chunk=3_000_000)
    pairs = spark.createDataFrame([("a", 1, "b", 1)], "ref_session string, ref_lap long, cmp_session string, cmp_lap long")
    assert {r["s_m"]: r["delta_s"] for r in laps.delta_trace(elapsed, pairs).collect()} == {0.0: 0.0, 50.0: -2.0, 100.0: -4.0}
    wrapped = spark.createDataFrame([("a", i, i, s, 1.0, 1, 100.0) for i, s in enumerate([0.0, 45.0, 95.0, 3.0, 50.0])], cols)
    assert [r["lap"] for r in laps.split_laps(wrapped, ["t_us", "event_id"], chunk=2).orderBy("t_us").collect()] == [1, 1, 1, 2, 2]


def test_clock_against_sequential(spark):
    rows, drift, held = [], 0.001, {}
    for i in range(200):
        received = i // 2 * 40 + (i // 2 * 7) % 13 + (30_000 if i >= 120 else 0)
        rows.append(("l", i // 2, i, received, (65_400 + i * 21 + i * i % 5) % 65_536))
    want, last, d, top, offset, heard = {}, None, 0, 0, 0.0, None
    for n in range(100):
        pair = [r for r in rows if r[1] == n]
        received = pair[0][3]
        if last is None or received - heard > 20_000:
            last, d, top, offset = pair[0][4], 0, 0, float(received)
        times = []
        for r in pair:
            d += (r[4] - last + 32_768) % 65_536 - 32_768
            last = r[4]
            if d > top:
                offset += (d - top) * drift
                top = d
            offset = min(offset, received - d)
            times.append((r[2], d))
        heard = received if heard is None else max(heard, received)
        want.update({line: t + int(offset) for line, t in times})
    df = spark.createDataFrame(rows, "link string, notification long, line long, received_ms long, counter long")
    got = {r["line"]: r["placed_ms"] for r in device.align_clock(df, ["link"], ["line"], 17).collect()}
    assert got == want


def test_planted_field_is_found(spark):
    def curve(t):
        return 60 + 40 * math.sin(t / 15) + 15 * math.sin(t / 4.7)

    can = [("s", "d", 0x202, i * 100, i, 8, f"{i % 7:02x}{i % 256:02x}00{int(curve(i / 10 - 0.4) * 100):04x}000000") for i in range(1800)]
    frames_ = spark.createDataFrame(can, "session string, device string, can_id long, t_ms long, seq long, dlc long, data_hex string")
    gps = spark.createDataFrame([("s", "d", i * 1000, i, curve(i)) for i in range(180)], "session string, device string, t_ms long, seq long, speed_kph double")
    gyro = spark.createDataFrame([("s", "d", i * 500, i, 0.0, math.sin(i / 9), 0.0) for i in range(360)], "session string, device string, t_ms long, seq long, x double, y double, z double")
    out = discovery.analyse(frames_, gps, gyro)
    best = out["candidates"].where("channel = 'speed_kph' AND rank_no = 1").first()
    assert (best["start"], best["length"], best["little_endian"], best["lag_ms"]) == (31, 16, False, -400)
    assert best["r"] > 0.99 and abs(best["factor"] - 0.01) < 0.0005
    classes = {r["byte"]: r["class"] for r in out["bytes"].collect()}
    assert classes[1] == "counter" and classes[2] == "constant" and classes[3] == "varying"


def test_bytes_by_hand(spark):
    data = [("s", "d", 1, i * 10, i, 4, f"aa{i * 3 % 256:02x}{0x50 | (i % 16):02x}{i * i * 37 % 251:02x}") for i in range(40)]
    words = inventory.with_words(spark.createDataFrame(data, "session string, device string, can_id long, t_ms long, seq long, dlc long, data_hex string"), ["t_ms", "seq"], 70)
    got = [r["class"] for r in inventory.byte_inventory(words, inventory.id_inventory(words)).orderBy("byte").collect()]
    assert got == ["constant", "counter", "counter", "varying"]
