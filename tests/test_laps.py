"""Laps of a known course, in the relational form and on a stream of several micro-batches."""

import math

import pytest
from pyspark.sql import functions as F

from roadlake.operators.lap_machine import Profile, laps
from roadlake.operators.laps import place_samples
from roadlake.streaming.laps import laps_stream
from roadlake.streaming.run import replayed, run_to_table

RECORD = "session_key string, t_ms long, kind string, seq long, lat double, lon double, speed double, magnitude double"
RADIUS_M, LAP_S, PROFILE = 300.0, 60, Profile(has_imu=False)


def course(session, start_ms, rounds):
    """An anchor, then fixes each second around a circle through it, `rounds` times and a bit."""
    rows = [(session, start_ms, "anchor", 0, 40.0, -111.0, None, None)]
    for s in range(rounds * LAP_S + 10):
        angle = 2 * math.pi * s / LAP_S
        north, east = RADIUS_M * math.sin(angle), RADIUS_M * (1 - math.cos(angle))
        rows.append((session, start_ms + 1000 * (s + 1), "gps", s + 1, 40.0 + math.degrees(north / 6_371_000), -111.0 + math.degrees(east / 6_371_000 / math.cos(math.radians(40.0))), 100.0, None))
    return rows


@pytest.fixture(scope="module")
def records(spark):
    rows = [r for k, n in enumerate((1, 2, 5)) for r in course(f"s{k}", 7_000 * k, n)]
    return spark.createDataFrame(rows, RECORD)


def check(found):
    got = sorted((r["session_key"], r["lap_number"]) for r in found)
    assert got == [("s0", 1), ("s1", 1), ("s1", 2), *(("s2", k) for k in range(1, 6))]
    for r in found:
        assert abs(r["lap_time_ms"] - 1000 * LAP_S) <= 2000
        assert r["distance_m"] == pytest.approx(2 * math.pi * RADIUS_M, rel=0.05)


def test_batch(records):
    check(laps(records, PROFILE).collect())


def test_stream(records):
    stream = laps_stream(replayed(records, "t_ms", batches=5), PROFILE)
    check(run_to_table(stream).collect())


def test_both_agree(records):
    columns = ["session_key", "epoch", "lap_number", "lap_start_ms", "lap_end_ms", F.round("distance_m", 1).alias("distance_m")]
    batch = {tuple(r) for r in laps(records, PROFILE).select(*columns).collect()}
    assert batch == {tuple(r) for r in run_to_table(laps_stream(replayed(records, "t_ms", batches=7), PROFILE)).select(*columns).collect()}


def test_samples_between_fixes_across_the_line(spark):
    """Fixes each second on a track of 100 m, samples between them; the line is crossed between the second and third fix."""
    fixes = spark.createDataFrame([("s", k * 1_000_000, k, m, 100.0) for k, m in ((0, 10.0), (1, 90.0), (2, 30.0), (3, 80.0), (10, 90.0), (11, 95.0))], "session string, t_us long, event_id long, s_m double, track_length_m double")
    times = [-1, 0, 500_000, 1_200_000, 1_250_000, 1_500_000, 2_999_999, 4_000_000, 10_500_000, 11_000_000]
    samples = spark.createDataFrame([("s", t, 7.0) for t in times] + [("none", 0, 1.0)], "session string, t_us long, ax double")
    got = {(r.session, r.t_us): (None if r.s_m is None else round(r.s_m, 4), r.lap, r.ax) for r in place_samples(samples, fixes, ["t_us", "event_id"]).collect()}
    assert got == {
        ("s", -1): (None, None, 7.0), ("s", 0): (10.0, 1, 7.0), ("s", 500_000): (50.0, 1, 7.0), ("s", 1_200_000): (98.0, 1, 7.0), ("s", 1_250_000): (0.0, 2, 7.0), ("s", 1_500_000): (10.0, 2, 7.0),
        ("s", 2_999_999): (80.0, 2, 7.0), ("s", 4_000_000): (None, None, 7.0), ("s", 10_500_000): (92.5, 2, 7.0), ("s", 11_000_000): (None, None, 7.0), ("none", 0): (None, None, 1.0)}
