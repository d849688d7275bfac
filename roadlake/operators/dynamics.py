"""Vehicle dynamics over samples of the IMU and the wheels: slip events and the grip envelope."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.operators.ordered import HOUR_US, last_known, number_runs, scan
from roadlake.session import spread

KEYS = ["session", "device"]

# Defaults of our own: slip that begins and that ends an event, a speed below which ratios say nothing, a gap in the samples.
SLIP_ON, SLIP_OFF = 0.15, 0.05
MIN_KPH = 5.0
MAX_GAP_US = 500_000


def slip_ratio(driven: Column, undriven: Column, min_kph: float = MIN_KPH) -> Column:
    """How far the driven wheels turn faster (wheelspin, above 0) or slower (lockup, below 0) than the car moves, as a share of
    the faster of the two; null where neither reaches `min_kph` or one is unknown."""
    faster = F.greatest(driven, undriven)
    return F.when(driven.isNotNull() & undriven.isNotNull() & (faster >= min_kph), (driven - undriven) / faster)


def slip_state(rows: DataFrame, order: list[str], keys: list[str] = KEYS, on: float = SLIP_ON, off: float = SLIP_OFF, max_gap_us: int = MAX_GAP_US, chunk: int = HOUR_US) -> DataFrame:
    """`rows` (keys, t_us, slip) with `state` (1 wheelspin, -1 lockup, 0 grip) and `stretch`, a number for samples without a gap.

    Two thresholds: an event begins where slip reaches `on` and lasts until it is below `off`; in between the state is what it
    was. So the state is that of the last row that decides it: a carry-forward by chunks, no sequential fold. A gap of more
    than `max_gap_us` ends an event; a row of unknown slip decides nothing."""
    stretched = number_runs(rows, keys, order, F.struct("t_us"), lambda p, c: c["t_us"] - p["t_us"] > max_gap_us, "stretch", chunk).drop("stretch_prev")

    def held(size: Column):
        return last_known(F.when(size >= on, True).when(size < off, False))

    out = scan(stretched, [*keys, "stretch"], order, {"_spin": held(F.col("slip")), "_lock": held(-F.col("slip"))}, chunk)
    return out.withColumn("state", F.when(F.col("_spin"), 1).when(F.col("_lock"), -1).otherwise(0)).drop("_spin", "_lock")


def slip_events(rows: DataFrame, order: list[str], keys: list[str] = KEYS, on: float = SLIP_ON, off: float = SLIP_OFF, max_gap_us: int = MAX_GAP_US, chunk: int = HOUR_US) -> DataFrame:
    """One row per event: kind, first and last sample, samples, the peak of slip and where it was. `rows` as for `slip_state`, with
    `s_m`, the place on the track (null off it)."""
    states = slip_state(rows, order, keys, on, off, max_gap_us, chunk)
    runs = number_runs(states, [*keys, "stretch"], order, F.struct("state"), lambda p, c: p["state"] != c["state"], "run", chunk)
    peak = F.max_by(F.struct("slip", "s_m"), F.when(F.col("slip").isNotNull(), F.struct(F.abs("slip"), *[-F.col(c) for c in order])))
    events = runs.where("state <> 0").groupBy(*keys, "stretch", "run", "state").agg(F.min("t_us").alias("started_us"), F.max("t_us").alias("ended_us"), F.count("*").alias("samples"), peak.alias("peak"))
    return events.select(*keys, F.when(F.col("state") == 1, "wheelspin").otherwise("lockup").alias("kind"), "started_us", "ended_us", "samples", F.col("peak.slip").alias("peak_slip"), F.col("peak.s_m").alias("peak_s_m"))


# ---- the grip envelope ----

def hull_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Numbers of the corners of the convex hull, against the clock from the leftmost; points on an edge are no corners."""
    order = np.lexsort((y, x))
    keep = np.ones(len(order), bool)
    keep[1:] = (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)
    order = order[keep].tolist()
    if len(order) < 3:
        return np.array(order, np.int64)
    px, py = x.tolist(), y.tolist()

    def chain(points):
        out = []
        for k in points:
            while len(out) > 1 and (px[out[-1]] - px[out[-2]]) * (py[k] - py[out[-2]]) - (py[out[-1]] - py[out[-2]]) * (px[k] - px[out[-2]]) <= 0:
                out.pop()
            out.append(k)
        return out[:-1]

    return np.array(chain(order) + chain(order[::-1]), np.int64)


FEW = 4  # points of a key in a batch that are passed on as they are


def _corners(keys: list[str]):
    """The corners of each key's points within the rows of a task, batch by batch: the hull of hulls is the hull. A key of few
    points in a batch passes on all of them, so many small keys cost no step of Python each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            number = batch.select(keys).to_pandas().groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
            order = np.argsort(number, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(number[order], prepend=-1)), len(order))
            x, y = batch.column("x").to_numpy(), batch.column("y").to_numpy()
            kept = np.ones(len(order), bool)
            for k in np.flatnonzero(np.diff(edges) > FEW):
                mine = order[edges[k] : edges[k + 1]]
                kept[mine] = False
                kept[mine[hull_of(x[mine], y[mine])]] = True
            yield batch.filter(pa.array(kept))

    return run


def _hulls(keys: list[str]):
    """The hull of each key with its corners numbered, over rows that come sorted by key. Of a key that goes on in the next batch only
    the corners so far are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            number = rows.select(keys).to_pandas().groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
            edges = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(number)).tolist()
            x, y = rows.column("x").to_numpy(), rows.column("y").to_numpy()
            found = [a + hull_of(x[a:b], y[a:b]) for a, b in zip(edges, edges[1:])]
            held = rows.take(pa.array(found.pop()))
            if found:
                yield from numbered(rows, found)
        if held is not None:
            yield from numbered(held, [np.arange(held.num_rows)])

    def numbered(rows, found):
        corner = pa.array(np.concatenate([np.arange(len(f)) for f in found]), pa.int32())
        return rows.take(pa.array(np.concatenate(found))).append_column("corner", corner).combine_chunks().to_batches()

    return run


def envelope(samples: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The corners of the convex hull of each key's points (keys, corner, x, y), against the clock from the leftmost.

    Points are reduced to the corners of their Arrow batch where they are read, then dealt by key, sorted, and reduced batch by
    batch: no task holds a session's samples, and a key is a slice of a batch, not a group of its own. Points with a
    null or NaN coordinate are left out."""
    known = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in "xy"]
    points = samples.where(known[0] & known[1]).select(*keys, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    corners = spread(points.mapInArrow(_corners(keys), points.schema), *keys).sortWithinPartitions(*keys)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema)
    return corners.mapInArrow(_hulls(keys), f"{schema}, corner int")


def grip_used(samples: DataFrame, hull: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """`samples` with `grip_used`: how far out a point lies on the way from rest to the envelope, 1 on the envelope itself.

    That is the largest share over the hull's edges, seen from the origin, so a hull travels as a short list of edges; null
    where the envelope does not go round the origin, as before a car has both braked and turned either way."""
    corner = F.struct("corner", "x", "y")
    lists = hull.groupBy(*keys).agg(F.array_sort(F.collect_list(corner)).alias("_c"))
    following = F.concat(F.slice("_c", 2, F.greatest(F.size("_c") - 1, F.lit(1))), F.slice("_c", 1, 1))

    def edge(p):
        (a, b) = p["a"], p["b"]
        nx, ny = b["y"] - a["y"], a["x"] - b["x"]  # outward, since corners go against the clock
        return F.struct(nx.alias("x"), ny.alias("y"), (nx * a["x"] + ny * a["y"]).alias("away"))

    edges = F.transform(F.arrays_zip(F.col("_c").alias("a"), following.alias("b")), edge)
    around = lists.where(F.size("_c") >= 3).select(*keys, edges.alias("_e")).where(F.forall("_e", lambda e: e["away"] > 0))
    share = F.array_max(F.transform("_e", lambda e: (e["x"] * F.col("x") + e["y"] * F.col("y")) / e["away"]))
    return samples.join(around, keys, "left").withColumn("grip_used", share).drop("_e")


# ---- balance ----

BALANCE_MPS = 3.0  # below it the model says little
NEUTRAL = 0.05  # of the expected yaw rate, within which a car is neutral


def balance_model(samples: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, samples, wheelbase, gradient, offset) of each car: the bicycle model steer = offset + wheelbase * yaw / speed +
    gradient * yaw * speed, fitted by least squares.

    `samples`: keys, speed_mps, yaw_rate and steer_rad at the wheels. The normal equations are nine sums and a count, which
    merge before the shuffle, so one car with a third of all samples costs no more than any other. Coefficients are null for
    cars whose samples do not tell them apart, as on a straight or at one speed."""
    v, r, steer = F.col("speed_mps"), F.col("yaw_rate"), F.col("steer_rad")
    x, y = r / v, r * v
    fit = samples.where((v >= BALANCE_MPS) & r.isNotNull() & steer.isNotNull())
    sums = {"x": x, "y": y, "d": steer, "xx": x * x, "xy": x * y, "yy": y * y, "xd": x * steer, "yd": y * steer}
    added = fit.groupBy(*keys).agg(F.count("*").alias("samples"), *[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    mean = {n: F.col(f"_{n}") / F.col("samples") for n in sums}
    xx, yy, xy = mean["xx"] - mean["x"] * mean["x"], mean["yy"] - mean["y"] * mean["y"], mean["xy"] - mean["x"] * mean["y"]
    xd, yd = mean["xd"] - mean["x"] * mean["d"], mean["yd"] - mean["y"] * mean["d"]
    det = xx * yy - xy * xy
    told = det > 1e-9 * xx * yy
    base, gradient = (xd * yy - yd * xy) / det, (yd * xx - xd * xy) / det
    solved = added.select(*keys, "samples", F.when(told, base).alias("wheelbase"), F.when(told, gradient).alias("gradient"), mean["x"].alias("_mx"), mean["y"].alias("_my"), mean["d"].alias("_md"))
    return solved.select(*keys, "samples", "wheelbase", "gradient", (F.col("_md") - F.col("wheelbase") * F.col("_mx") - F.col("gradient") * F.col("_my")).alias("offset"))


def balance(samples: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """`samples` with `expected_yaw` of the car's model without its gradient (a neutral car), `excess` (the part of the expected yaw
    rate by which the measured one is above it, or below 0 under it) and `balance`: understeer, oversteer, neutral, or null
    where nothing is expected of the car. The join is on the car; models are one row each."""
    coefficients = model.select(*keys, "wheelbase", "offset")
    v, r = F.col("speed_mps"), F.col("yaw_rate")
    expected = F.when(v >= BALANCE_MPS, (F.col("steer_rad") - F.col("offset")) * v / F.col("wheelbase"))
    out = samples.join(coefficients, keys, "left").withColumn("expected_yaw", expected).drop("wheelbase", "offset")
    turning = F.abs("expected_yaw") > 1e-3
    excess = F.when(turning, r / F.col("expected_yaw") - 1)
    return out.withColumn("excess", excess).withColumn("balance", F.when(excess < -NEUTRAL, "understeer").when(excess > NEUTRAL, "oversteer").when(excess.isNotNull(), "neutral"))
