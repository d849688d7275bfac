"""The gate against bad fixes: drift goes, a jump that time allows stays, a wrong start is left."""

import pytest

from roadlake.operators import fixes

SECOND = 1_000_000


def north(metres):
    return 40.0 + metres / 111_195.0


@pytest.mark.parametrize("chunk", [SECOND, 20 * SECOND, 10_000 * SECOND])
def test_gate(spark, chunk):
    drive = [(k, north(20.0 * k), 1.0, 9) for k in range(30)]
    garage = [(30 + k, north(600 + (5000 if k % 2 else -3000)), 1.0, 9) for k in range(20)]  # drift to and fro
    poor = [(50, north(600), 9.0, 9), (51, north(600), 1.0, 3), (52, None, 1.0, 9), (53, north(605), None, None)]
    later = [(600 + k, north(30_000 + 20.0 * k), 1.0, 9) for k in range(5)]  # after nine minutes, 30 km on: 200 kph
    wrong = [(0, 50.0, 1.0, 9)] + [(1 + k, north(20.0 * k), 1.0, 9) for k in range(8)]  # a start that is a thousand km off
    rows = [("a", "d", s * SECOND, k, lat, -111.0, hdop, sats) for k, (s, lat, hdop, sats) in enumerate(drive + garage + poor + later)]
    rows += [("b", "d", s * SECOND, k, lat, -111.0, hdop, sats) for k, (s, lat, hdop, sats) in enumerate(wrong)]
    ddl = "session string, device string, t_us long, event_id long, lat double, lon double, hdop double, num_sats int"
    found = fixes.judge_fixes(spark.createDataFrame(rows, ddl), ["t_us", "event_id"], chunk=chunk)
    got = {(r.session, r.event_id): r.reason for r in found.collect()}
    jump = "IMPOSSIBLE_JUMP"
    want = {("a", k): None for k in range(30)} | {("a", 30 + k): jump for k in range(20)} | {("a", 50): "POOR_HDOP", ("a", 51): "FEW_SATELLITES", ("a", 52): "NO_POSITION", ("a", 53): None}
    want |= {("a", 54 + k): None for k in range(5)} | {("b", 0): None} | {("b", 1 + k): jump if k < 4 else None for k in range(8)}
    assert got == want
