"""The field search from samples alone, against the same search over a grid held in memory."""

import math

import numpy as np
import pytest

from roadlake.operators import discovery, inventory

PAYLOAD = 4


def plain(frames, reference, search):
    """{(length, little_endian, start, signed): (r, lag, n)} of one pair, by numpy over its whole grid."""
    t0, t1 = max(frames[0][0], reference[0][0]), min(frames[-1][0], reference[-1][0])
    grid = np.arange(t0, t1 + 1, search.grid_ms)
    times = np.array([t for t, _ in frames])
    data = [frames[k][1] for k in np.searchsorted(times, grid, "right") - 1]
    y = np.interp(grid, [t for t, _ in reference], [v for _, v in reference])
    out = {}
    for length, little_endian, start, shift in discovery._fields(PAYLOAD, search.lengths):
        raw = np.array([int.from_bytes(d.ljust(8, b"\0"), "little" if little_endian else "big") >> shift & (1 << length) - 1 for d in data])
        for signed in (False, True):
            x = np.where(signed & (raw >= 1 << length - 1), raw - (1 << length), raw).astype(float)
            best = (0.0, 0, 0)
            for lag in range(-search.max_lag, search.max_lag + 1):
                a, b = (x[: len(x) - lag], y[lag:]) if lag >= 0 else (x[-lag:], y[:lag])
                if len(a) >= 3 and a.std() > 0 and b.std() > 0:
                    r = float(np.corrcoef(a, b)[0, 1])
                    if abs(r) > abs(best[0]) + 1e-9:
                        best = (r, lag * search.grid_ms, len(a))
            if x.var() >= 1e-9 and abs(best[0]) >= search.threshold and best[2] >= 5:
                out[(length, little_endian, start, signed)] = best
    return out


@pytest.mark.parametrize("block", [7, 64, 65_536])
def test_search_equals_that_over_the_whole_grid(spark, block):
    """Frames and references with gaps longer than a block, and blocks shorter than the lags."""
    search = discovery.Search(lengths=(8, 12))

    def speed(t):
        return 60 + 40 * math.sin(t / 9_000) + 15 * math.sin(t / 2_700)

    frames = [(t, int(speed(t - 600) * 30).to_bytes(2, "big") + bytes([t // 130 % 7, 9])) for t in range(0, 60_000, 130) if not 20_000 < t < 33_000]
    reference = [(t, speed(t)) for t in range(450, 58_000, 370) if not 40_000 < t < 47_000]
    can = spark.createDataFrame([("s", "d", 5, t, k, PAYLOAD, d.hex()) for k, (t, d) in enumerate(frames)], "session string, device string, can_id long, t_ms long, seq long, dlc long, data_hex string")
    known = spark.createDataFrame([("s", "d", "speed_kph", t, k, v) for k, (t, v) in enumerate(reference)], "session string, device string, channel string, t_ms long, seq long, value double")
    words = inventory.with_words(can, ["t_ms", "seq"])
    pairs = discovery.pair_status(words, inventory.id_inventory(words), known, search)
    found = discovery.correlate(pairs, words, known, search, block=block).collect()
    want = plain(frames, reference, search)
    assert want and {(r.length, r.little_endian, r.start, r.signed) for r in found} == want.keys()
    for r in found:
        expected = want[(r.length, r.little_endian, r.start, r.signed)]
        assert r.r == pytest.approx(expected[0], abs=1e-9) and (r.lag_ms, r.samples) == expected[1:]
