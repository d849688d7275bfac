"""Lap analytics over track positions: splitting, range lookup by arc length, delta traces, segment statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.rounding import half_even
from roadlake.operators.asof import bracket
from roadlake.operators.ordered import HOUR_US, next_, number_runs, scan
from roadlake.session import cut_lineage

KEYS = ["session"]
WRAP_SHARE = 0.4
WRAP_MIN_M = 50.0


def split_laps(positions: DataFrame, order: list[str], keys: list[str] = KEYS, chunk: int = HOUR_US) -> DataFrame:
    """Add `lap`: a new one where arc length falls by more than 0.4 of the track, at least 50 m. The track's length is
    the greatest length, or position without one, over the whole session."""
    return _lapped(positions, order, keys, chunk).drop("_length")


def _lapped(positions: DataFrame, order: list[str], keys: list[str], chunk: int) -> DataFrame:
    own = F.coalesce(F.nullif("track_length_m", F.lit(0.0)), F.col("s_m"))
    length = positions.groupBy(*keys).agg(F.max(own).alias("_length"))
    rows = positions.join(length, keys)
    value = F.struct("s_m", F.greatest(F.col("_length") * WRAP_SHARE, F.lit(WRAP_MIN_M)).alias("wrap"))
    return number_runs(rows, keys, order, value, lambda p, c: p["s_m"] - c["s_m"] > c["wrap"], "lap", chunk).drop("lap_prev")


def place_samples(samples: DataFrame, positions: DataFrame, order: list[str], keys: list[str] = KEYS, chunk: int = HOUR_US, max_gap_us: int = 5_000_000) -> DataFrame:
    """`s_m` and `lap` for every sample of a faster channel (keys, t_us and any other columns), between the fixes around it.

    Arc length is a circle, so it is unwrapped before it is interpolated: the fix after the start line counts from the
    line on, and what lies beyond the line belongs to the next lap. A sample at the line itself begins the lap. Both are
    null before the first fix, after the last one, and between fixes more than `max_gap_us` apart. One union and one scan
    by time; no pair of a sample and a fix is formed."""
    fixes = _lapped(positions.where(F.col("s_m").isNotNull()), order, keys, chunk)
    rows = bracket(samples, fixes, keys, "t_us", order[-1], F.struct("s_m", "lap", "_length"), chunk, grid_first=False)
    a, b = F.col("before"), F.col("after")
    over = b["v"]["lap"] - a["v"]["lap"]
    length = a["v"]["_length"]
    share = (F.col("t_us") - a["t"]) / (b["t"] - a["t"])
    ahead = a["v"]["s_m"] + share * (b["v"]["s_m"] + over * length - a["v"]["s_m"])
    known = (b["t"] - a["t"] <= max_gap_us) & (b["t"] > a["t"])
    crossed = (over > 0) & (ahead >= length)
    return rows.withColumn("s_m", F.when(known, F.when(crossed, ahead - over * length).otherwise(ahead))).withColumn("lap", F.when(known, F.when(crossed, b["v"]["lap"]).otherwise(a["v"]["lap"]))).drop("before", "after")


def lap_table(laps: DataFrame, order: list[str], keys: list[str] = KEYS) -> DataFrame:
    """Start, end, duration, samples and end positions of every lap."""
    position = F.struct(*order)
    ends = laps.groupBy(*keys, "lap").agg(
        F.min("t_us").alias("started_us"), F.max("t_us").alias("ended_us"), F.count("*").alias("samples"),
        F.min_by(F.struct("s_m", "speed", "track_id"), position).alias("first"), F.max_by(F.struct("s_m", "speed"), position).alias("last"),
    )
    return ends.withColumn("duration_s", (F.col("ended_us") - F.col("started_us")) / F.lit(1e6))


def _pairs(laps: DataFrame, order: list[str], keys: list[str], chunk: int) -> DataFrame:
    """Each sample with the one after it in its lap; the last with itself, which catches its own position."""
    here = F.struct("s_m", "speed", "t_us")
    out = scan(laps, [*keys, "lap"], order, {"right": next_(here)}, chunk)
    return out.withColumn("left", here).withColumn("right", F.coalesce("right", here))


def _between(target: Column, name: str) -> Column:
    a, b = F.col("left"), F.col("right")
    ratio = (target - a["s_m"]) / F.nullif(b["s_m"] - a["s_m"], F.lit(0.0))
    return F.coalesce(a[name] + ratio * (b[name] - a[name]), b[name], a[name])


def _lookup(pairs: DataFrame, order: list[str], keys: list[str], target: Column) -> DataFrame:
    """First pair in time order around each target (the rows are already pairs that hold `target`)."""
    at_speed = F.when(F.col("left.speed").isNull(), F.col("right.speed")).when(F.col("right.speed").isNull(), F.col("left.speed")).otherwise(
        _between(target, "speed")
    )
    found = F.struct(_between(target, "t_us").alias("t"), at_speed.alias("speed"))
    return pairs.groupBy(*keys, "lap", target.alias("target_m")).agg(F.min_by(found, F.struct(*order)).alias("hit"))


def _covered(lookup: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    joined = lookup.join(table, [*keys, "lap"])
    inside = (F.col("target_m") >= F.col("first.s_m")) & (F.col("target_m") <= F.col("last.s_m"))
    speed = (
        F.when(F.col("target_m") <= F.col("first.s_m"), F.col("first.speed"))
        .when(F.col("target_m") >= F.col("last.s_m"), F.col("last.speed"))
        .otherwise(F.col("hit.speed"))
    )
    return joined.where(inside).select(
        *keys, "lap", "target_m", ((F.col("hit.t") - F.col("started_us")) / F.lit(1e6)).alias("elapsed_s"), speed.alias("speed")
    )


def elapsed_on_grid(laps: DataFrame, order: list[str], step_m: float, keys: list[str] = KEYS, chunk: int = HOUR_US) -> DataFrame:
    """Elapsed time at 0, step, 2 step, ... of every lap.

    The range join is turned round: each pair of samples lists the grid points inside it, so the join is an explode and
    the choice of the first pair a partial aggregation."""
    pairs = _pairs(laps, order, keys, chunk)
    low, high = F.ceil(F.col("left.s_m") / step_m), F.floor(F.col("right.s_m") / step_m)
    spread = pairs.where((low <= high) & (high >= 0)).select(
        "*", F.explode(F.sequence(F.greatest(low, F.lit(0)), high)).alias("_g")
    )
    hits = _lookup(spread, order, keys, F.col("_g") * F.lit(step_m))
    return _covered(hits, lap_table(laps, order, keys), keys)


def delta_trace(elapsed: DataFrame, pairs: DataFrame) -> DataFrame:
    """Comparison minus reference along the track. `pairs`: ref_session, ref_lap, cmp_session, cmp_lap."""
    ref = elapsed.select(F.col("session").alias("ref_session"), F.col("lap").alias("ref_lap"), "target_m", F.col("elapsed_s").alias("ref_s"))
    cmp_ = elapsed.select(F.col("session").alias("cmp_session"), F.col("lap").alias("cmp_lap"), "target_m", F.col("elapsed_s").alias("cmp_s"))
    both = ref.join(pairs, ["ref_session", "ref_lap"]).join(cmp_, ["cmp_session", "cmp_lap", "target_m"])
    return both.select(
        *pairs.columns, half_even(F.col("target_m"), 3).alias("s_m"), half_even(F.col("ref_s"), 3).alias("reference_elapsed_s"),
        half_even(F.col("cmp_s"), 3).alias("comparison_elapsed_s"), half_even(F.col("cmp_s") - F.col("ref_s"), 3).alias("delta_s"),
    )


def different_tracks(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of laps that cannot be compared because they were driven on different tracks."""
    side = table.select("session", "lap", F.col("first.track_id").alias("track_id"))
    ref = side.select(F.col("session").alias("ref_session"), F.col("lap").alias("ref_lap"), F.col("track_id").alias("ref_track"))
    cmp_ = side.select(F.col("session").alias("cmp_session"), F.col("lap").alias("cmp_lap"), F.col("track_id").alias("cmp_track"))
    return pairs.join(ref, ["ref_session", "ref_lap"]).join(cmp_, ["cmp_session", "cmp_lap"]).where("ref_track <> cmp_track")


def segment_stats(
    laps: DataFrame, order: list[str], segments: list[tuple[str, float, float]], keys: list[str] = KEYS, chunk: int = HOUR_US
) -> DataFrame:
    """Per lap and named segment: duration, entry and exit speed, and the speeds of the samples inside.

    The segments are configuration: every pair of samples picks the segment ends it holds from one constant array."""
    usable = [(n, float(a), float(b)) for n, a, b in segments if b > a]
    ends = F.array(*[F.lit(v) for v in sorted({x for _, a, b in usable for x in (a, b)})])
    pairs = _pairs(laps, order, keys, chunk)
    held = pairs.select("*", F.explode(F.filter(ends, lambda x: x.between(F.col("left.s_m"), F.col("right.s_m")))).alias("_target"))
    at = _covered(_lookup(held, order, keys, F.col("_target")), lap_table(laps, order, keys), keys)
    named = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, a, b in usable])
    sides = at.select("*", F.explode(F.filter(named, lambda s: (s["a"] == F.col("target_m")) | (s["b"] == F.col("target_m")))).alias("g"))
    here = F.struct("elapsed_s", "speed")
    timed = sides.groupBy(*keys, "lap", "g").agg(
        F.max(F.when(F.col("target_m") == F.col("g.a"), here)).alias("entry"), F.max(F.when(F.col("target_m") == F.col("g.b"), here)).alias("exit")
    ).where("entry IS NOT NULL AND exit IS NOT NULL")
    inside = laps.where(F.col("speed").isNotNull()).select(
        *keys, "lap", "speed", F.explode(F.filter(named, lambda s: F.col("s_m").between(s["a"], s["b"]))).alias("g")
    ).groupBy(*keys, "lap", "g").agg(F.min("speed").alias("low"), F.avg("speed").alias("mean"), F.max("speed").alias("high"))
    return timed.join(inside, [*keys, "lap", "g"], "left").select(
        *keys, "lap", F.col("g.name").alias("name"), F.col("g.a").alias("s_start_m"), F.col("g.b").alias("s_end_m"),
        half_even(F.col("exit.elapsed_s") - F.col("entry.elapsed_s"), 3).alias("duration_s"),
        half_even(F.col("entry.speed"), 3).alias("entry_speed_kph"), half_even(F.col("exit.speed"), 3).alias("exit_speed_kph"),
        half_even(F.col("low"), 3).alias("min_speed_kph"), half_even(F.col("mean"), 3).alias("mean_speed_kph"), half_even(F.col("high"), 3).alias("max_speed_kph"),
    )


def laps_of(positions: DataFrame, order: list[str], keys: list[str] = KEYS, chunk: int = HOUR_US) -> DataFrame:
    """Lap-numbered positions, materialised, for plans that use them more than once."""
    return cut_lineage(split_laps(positions, order, keys, chunk))
