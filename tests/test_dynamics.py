"""Slip events and the grip envelope against the plain rules."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.operators import dynamics


def plain_states(rows, on, off, gap):
    spin = lock = False
    before, out = None, []
    for t, slip in rows:
        if before is not None and t - before > gap:
            spin = lock = False
        if slip is not None:
            spin = slip >= on or (spin and slip >= off)
            lock = -slip >= on or (lock and -slip >= off)
        out.append(1 if spin else -1 if lock else 0)
        before = t
    return out


@pytest.mark.parametrize("chunk", [1, 7, 10_000])
def test_slip_equals_the_sequential_rule(spark, chunk):
    rng = random.Random(chunk)
    rows, t = [], 0
    for k in range(400):
        t += rng.choice([1, 1, 1, 2, 30])
        rows.append((t, rng.choice([None, 0.0, 0.04, 0.05, 0.1, 0.12, 0.15, 0.3, -0.1, -0.2, -0.04])))
    frame = spark.createDataFrame([("s", "d", k, t, slip, float(k)) for k, (t, slip) in enumerate(rows)], "session string, device string, event_id long, t_us long, slip double, s_m double")
    found = dynamics.slip_state(frame, ["t_us", "event_id"], max_gap_us=5, chunk=chunk).orderBy("event_id").collect()
    want = plain_states(rows, 0.15, 0.05, 5)
    assert [r.state for r in found] == want
    events = []
    for k, state in enumerate(want):
        new = k == 0 or want[k - 1] != state or rows[k][0] - rows[k - 1][0] > 5
        if state and new:
            events.append([state, []])
        if state:
            events[-1][1].append(k)
    expect = {(rows[ks[0]][0], rows[ks[-1]][0], "wheelspin" if s == 1 else "lockup", len(ks), max(abs(rows[k][1]) for k in ks if rows[k][1] is not None)) for s, ks in events}
    assert {(r.started_us, r.ended_us, r.kind, r.samples, abs(r.peak_slip)) for r in dynamics.slip_events(frame, ["t_us", "event_id"], max_gap_us=5, chunk=chunk).collect()} == expect


def test_envelope_is_the_hull_of_all_points(spark):
    rng = random.Random(4)
    points = {f"s{k}": [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(n)] for k, n in enumerate((3000, 50, 3))}
    points["grid"] = [(float(x), float(y)) for x in range(-3, 4) for y in range(-3, 4)] * 3
    points["line"] = [(float(x), float(x)) for x in range(5)]
    points["one"] = [(1.0, 2.0)] * 4
    rows = [(s, "d", x, y) for s, p in points.items() for x, y in p] + [("s1", "d", None, 1.0), ("s1", "d", float("nan"), 99.0)]
    samples = spark.createDataFrame(rows, "session string, device string, x double, y double").repartition(7)
    hull = dynamics.envelope(samples)
    found = {}
    for r in hull.collect():
        found.setdefault(r.session, {})[r.corner] = (r.x, r.y)
    for s, p in points.items():
        distinct = sorted(set(p))
        corners = set()
        for a in distinct:  # a corner has all others within less than half a turn
            angles = sorted(math.atan2(b[1] - a[1], b[0] - a[0]) for b in distinct if b != a)
            gaps = [b - a for a, b in zip(angles, angles[1:])] + [angles[0] + 2 * math.pi - angles[-1]] if angles else [9]
            if max(gaps) > math.pi + 1e-9:
                corners.add(a)
        assert set(found[s].values()) == corners and sorted(found[s]) == list(range(len(corners))) and found[s][0] == min(corners)
    used = dynamics.grip_used(samples, hull).where("session = 'grid'").select("x", "y", "grip_used").distinct().collect()
    assert all(r.grip_used == pytest.approx(max(abs(r.x), abs(r.y)) / 3) for r in used)
    assert dynamics.grip_used(samples, hull).where(F.col("session").isin("line", "one") & F.col("grip_used").isNotNull()).isEmpty()
    assert dynamics.grip_used(samples, hull).count() == samples.count()


def test_balance_recovers_planted_cars(spark):
    rng = random.Random(9)
    rows, cars = [], {"a": (2.7, 0.004, 0.01), "b": (2.4, -0.001, -0.02)}
    for car, (base, gradient, offset) in cars.items():
        for k in range(200):
            v, r = rng.uniform(4, 40), rng.uniform(-0.5, 0.5)
            rows.append((car, k, v, r, offset + base * r / v + gradient * r * v))
    rows += [("straight", k, 20.0, 0.0, 0.0) for k in range(5)] + [("a", 900, 1.0, 0.1, 9.0), ("a", 901, None, 0.1, 0.1), ("none", 1, 10.0, None, 0.1)]
    samples = spark.createDataFrame(rows, "car string, k int, speed_mps double, yaw_rate double, steer_rad double")
    model = dynamics.balance_model(samples, ["car"])
    found = {r.car: (r.wheelbase, r.gradient, r.offset, r.samples) for r in model.collect()}
    for car, (base, gradient, offset) in cars.items():
        assert found[car] == pytest.approx((base, gradient, offset, 200), rel=1e-9)
    assert found["straight"][:3] == (None, None, None) and "none" not in found
    out = {(r.car, r.k): r.balance for r in dynamics.balance(samples, model, ["car"]).where("abs(yaw_rate) > 0.1 and speed_mps > 30 or k > 800 or car not in ('a', 'b')").collect()}
    assert {b for (c, k), b in out.items() if c == "a" and k < 800} == {"understeer"} and {b for (c, k), b in out.items() if c == "b"} == {"oversteer"}
    assert {b for (c, k), b in out.items() if c not in ("a", "b") or k > 800} == {None}


def test_envelope_of_keys_that_go_on_over_batches(spark):
    """One key over many batches beside keys of one to nine points, a null key among them: no group of Python for each of them."""
    rng = random.Random(5)
    rows = [("hot", "d", rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(900)]
    rows += [(None if k == 7 else f"s{k}", "d", rng.random(), rng.random()) for k in range(40) for _ in range(k % 9 + 1)]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        hull = dynamics.envelope(spark.createDataFrame(rows, "session string, device string, x double, y double"))
        found = hull.collect()
        assert "FlatMapGroups" not in hull._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for session in {r[0] for r in rows}:
        points = [(x, y) for s, _, x, y in rows if s == session]
        want = dynamics.hull_of(*(np.array(v) for v in zip(*points)))
        assert [(r.x, r.y) for r in sorted((r for r in found if r.session == session), key=lambda r: r.corner)] == [points[k] for k in want]
