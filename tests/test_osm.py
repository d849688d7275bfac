"""Stitching against the plain way: lines merged one meeting point after the other."""

import random
from collections import Counter

import pytest

from roadlake.operators import osm


def merged(ways):
    """The lines of one candidate as sets of ways, and their points, joined at each point where two ends of two lines meet."""
    lines = {w: (frozenset([w]), list(p)) for w, p in sorted(ways.items())}
    meets = Counter(e for p in ways.values() for e in (p[0], p[-1]))
    for point in [p for p, n in meets.items() if n == 2]:
        at = [k for k, (_, p) in lines.items() for e in (p[0], p[-1]) if e == point]
        if len(at) != 2 or at[0] == at[1]:
            continue
        (ma, pa), (mb, pb) = lines.pop(at[0]), lines.pop(at[1])
        pa = pa if pa[-1] == point else pa[::-1]
        pb = pb if pb[0] == point else pb[::-1]
        lines[at[0]] = (ma | mb, pa + pb[1:])
    return list(lines.values())


def canonical(points, ring):
    """The same for either direction, and for a ring from any of its points."""
    if ring:
        points = points[:-1]
        turns = [points[k:] + points[:k] for k in range(len(points))] + [points[k::-1] + points[:k:-1] for k in range(len(points))]
        return min(turns)
    return min(points, points[::-1])


@pytest.mark.parametrize("seed", range(3))
def test_lines_equal_merging_one_by_one(spark, seed):
    rng = random.Random(seed)
    candidates = {}
    for c, (nodes, ways) in enumerate([(40, 30), (8, 30), (200, 150)]):
        found = {}
        for w in rng.sample(range(10_000), ways):
            a, b = rng.sample(range(nodes), 2) if rng.random() < 0.95 else [rng.randrange(nodes)] * 2
            found[w] = [(a, a), *((1000 + w, k) for k in range(rng.randrange(3))), (b, b)]
        candidates[f"c{c}"] = found
    order = list(range(70))
    rng.shuffle(order)
    candidates["long"] = {w: [(k, k), (k + 1, k + 1)][:: rng.choice([1, -1])] for k, w in enumerate(order)}
    candidates["ring"] = {w: [(k, k), ((k + 1) % 33, (k + 1) % 33)][:: rng.choice([1, -1])] for k, w in enumerate(order[:33])}
    candidates["two"] = {1: [(0, 0), (1, 1)], 2: [(0, 0), (5, 5), (1, 1)]}
    candidates["closed"] = {4: [(0, 0), (1, 1), (0, 0)], 5: [(9, 9), (8, 8)], 6: [(7, 7)]}
    rows = [(c, w, [{"lat": float(x), "lon": float(y)} for x, y in p]) for c, ws in candidates.items() for w, p in ws.items()]
    ways = spark.createDataFrame(rows + rows[:3] + [(None, 1, rows[0][2]), ("empty", 1, None)], "candidate string, way_id long, line array<struct<lat:double,lon:double>>")
    got = {}
    for r in osm.lines(osm.stitch(ways)).collect():
        got.setdefault(r.candidate, []).append((r.line_id, [(int(p.lat), int(p.lon)) for p in r.line]))
    members = {}
    for r in osm.stitched_ways(ways).collect():
        members.setdefault((r.candidate, r.line_id), {})[r.rank] = (r.way_id, r.reverse)
    for c, found in candidates.items():
        want = merged({w: p for w, p in found.items() if len(p) > 1})
        assert sorted(canonical(p, len(m) > 1 and p[0] == p[-1]) for m, p in want) == sorted(canonical(p, len(members[c, i]) > 1 and p[0] == p[-1]) for i, p in got[c])
        for line_id, points in got[c]:
            ranks = members[c, line_id]
            assert sorted(ranks) == list(range(len(ranks))) and min(w for w, _ in ranks.values()) == line_id
            assert (line_id, False) in ranks.values()  # a line runs as its smallest way does
            at = 0
            for _, (w, reverse) in sorted(ranks.items()):
                p = found[w][::-1] if reverse else found[w]
                assert points[at : at + len(p)] == p
                at += len(p) - 1
