"""The 50 Hz grid of the IMU against the rule by hand."""

import random

from roadlake.operators import device


def test_grid_and_seconds_equal_the_rule_without_a_join(spark):
    rng = random.Random(3)
    rows = [("d", s * 1000 + t, k, rng.random()) for s in (0, 1, 4) for k, t in enumerate(sorted(rng.choices(range(1000), k=(60, 10, 90)[s if s < 2 else 2])))]
    samples = spark.createDataFrame(rows, "device string, t_ms long, seq long, ax double")
    grid, seconds = device.resample_imu(samples, ["device"], ["ax"], "seq")
    want_grid, want_seconds = {}, {}
    for s in (0, 1, 4):
        own = sorted((t, k, v) for _, t, k, v in rows if t // 1000 == s)
        near = {g: min(((abs(t - g), t >= g, k if t >= g else -k, v) for t, k, v in own), key=lambda x: x[:3]) for g in range(s * 1000, s * 1000 + 1000, 20)}
        missing = sum(n[0] > 20 for n in near.values())
        offsets = [0, *(t - s * 1000 for t, _, _ in own), 1000]
        want_seconds[s * 1000] = (len(own), max(b - a for a, b in zip(offsets, offsets[1:])), missing, missing > 25)
        if missing <= 25:
            want_grid.update({g: (n[3], n[0] > 20, g % 100 == 0) for g, n in near.items()})
    assert {r.t_ms: (r.sample.ax, r.missing, r.has_quaternion) for r in grid.collect()} == want_grid
    assert {r.second_ms: (r.samples, r.max_gap_ms, r.missing_points, r.incomplete) for r in seconds.collect()} == want_seconds
    assert len({w[3] for w in want_seconds.values()}) == 2
    for out in (grid, seconds):
        assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
