"""A drive's summary from its vehicle state rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.rounding import half_even
from roadlake.functions.geo import haversine_km
from roadlake.functions.units import GRAVITY
from roadlake.operators.decode import ROLE_COLUMNS
from roadlake.operators.ordered import HOUR_US, last_known, next_, prev, running_sum, scan
from roadlake.session import cut_lineage

KEYS = ["session", "device"]

# The version of the metrics and their thresholds.
VERSION = 3
FRAME_US = 1_000_000
MOVING_KPH = 1.0
LATERAL_MIN_KPH = 10.0
GPS_GAP_S = 5.0
GPS_MOVING_KPH = 3.0
HARD_BRAKING_G = -0.35
HARD_ACCELERATION_G = 0.30
SHARP_CORNERING_G = 0.40
HIGH_RPM = 4000.0
SELECTORS = ("P", "R", "N", "D", "L")


def _neighbours(rows: DataFrame, order: list[str], chunk: int) -> DataFrame:
    """Everything the metrics need from other rows that does not depend on the sampling interval."""
    moving = F.coalesce(F.col("speed_kph") > MOVING_KPH, F.lit(False))
    braking = F.coalesce(F.col("brake_on"), F.lit(False))
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    place = F.when(located, F.struct("t_us", "lat", "lon"))
    in_gear = F.col("gear").isNotNull()
    in_drive = F.coalesce(F.col("prndl") == "D", F.lit(False))
    # with a selector, leaving Drive forgets the gear; without one, the gear alone decides
    selected = F.when(in_drive & in_gear, F.struct(F.col("gear").alias("g"))).when(
        ~in_drive, F.struct(F.lit(None).cast("double").alias("g"))
    )
    near = F.struct("t_us", "speed_kph")
    base = rows.withColumn("moving", moving).withColumn("braking", braking)
    return scan(
        base, KEYS, order,
        {
            "before": prev(near), "after": next_(near), "was_moving": prev(F.col("moving")), "was_braking": prev(F.col("braking")),
            "last_place": last_known(place, inclusive=False), "gear_held": last_known(selected, inclusive=False),
            "gear_before": last_known(F.col("gear"), inclusive=False),
        },
        chunk,
    )


def with_motion(rows: DataFrame, order: list[str], chunk: int = HOUR_US) -> DataFrame:
    """State rows with neighbours, the session's interval and the accelerations.

    The neighbour scan is checkpointed once: the interval (the session's smallest gap) is taken from it, and the runs
    of the events need the accelerations of the row before, a second scan."""
    near = cut_lineage(_neighbours(rows, order, chunk))
    gap = (F.col("t_us") - F.col("before.t_us")) / F.lit(1e6)
    span = near.groupBy(*KEYS).agg(F.coalesce(F.min(gap), F.lit(1.0)).alias("interval_s"))
    timed = near.join(span, KEYS)
    step = F.col("interval_s")
    contiguous = F.abs((F.col("after.t_us") - F.col("before.t_us")) / F.lit(1e6) - step * 2) <= step / 2
    lon_g = F.when(contiguous, (F.col("after.speed_kph") - F.col("before.speed_kph")) / 3.6 / (step * 2) / GRAVITY)
    turn = F.radians(F.sqrt(sum((F.col("gyro_mean")[a] * F.col("gyro_mean")[a] for a in "xyz"), F.lit(0.0))))
    lat_g = F.when(F.col("speed_kph") >= LATERAL_MIN_KPH, F.col("speed_kph") / 3.6 * turn / GRAVITY)
    lp = F.col("last_place")
    going = F.when(F.col("speed_kph").isNotNull(), F.col("moving")).otherwise(F.coalesce("gps_speed_kph", F.lit(0.0)) > GPS_MOVING_KPH)
    counted = F.col("lat").isNotNull() & F.col("lon").isNotNull() & going & ((F.col("t_us") - lp["t_us"]) / F.lit(1e6) <= GPS_GAP_S)
    return (
        timed.withColumn("lon_g", lon_g).withColumn("lat_g", lat_g)
        .withColumn("gps_step_km", F.when(counted, haversine_km(lp["lat"], lp["lon"], F.col("lat"), F.col("lon"))))
    )


def _flags() -> dict[str, Column]:
    return {
        "hard_braking": F.coalesce(F.col("lon_g") <= HARD_BRAKING_G, F.lit(False)),
        "hard_acceleration": F.coalesce(F.col("lon_g") >= HARD_ACCELERATION_G, F.lit(False)),
        "sharp_cornering": F.coalesce(F.col("lat_g") >= SHARP_CORNERING_G, F.lit(False)),
    }


def event_runs(motion: DataFrame, order: list[str], chunk: int = HOUR_US) -> DataFrame:
    """Runs of consecutive rows beyond each threshold, per session."""
    flags = _flags()
    narrow = motion.select(*KEYS, *order, F.struct(*[f.alias(n) for n, f in flags.items()]).alias("f"))
    seen = scan(narrow, KEYS, order, {"p": prev(F.col("f"))}, chunk)
    return seen.groupBy(*KEYS).agg(
        *[F.count_if(F.col("f")[n] & ~F.coalesce(F.col("p")[n], F.lit(False))).alias(n) for n in flags]
    )


def _span(column: str, order: list[str]) -> Column:
    known = F.when(F.col(column).isNotNull(), F.struct(*order))
    values = F.struct(
        half_even(F.min_by(column, known), 1).alias("start"), half_even(F.max(column), 1).alias("max"), half_even(F.max_by(column, known), 1).alias("end")
    )
    return F.when(F.count(column) > 0, values)


def frame_quality(rows: DataFrame, order: list[str]) -> DataFrame:
    """Per session: frames used and incomplete, and filled IMU points counted once per frame."""
    per_frame = rows.groupBy(*KEYS, "frame_base_us").agg(
        F.min("complete").alias("complete"),
        F.max_by(F.coalesce("imu_filled_in_frame", F.lit(0)), F.struct(*order)).alias("filled"),
    )
    return per_frame.groupBy(*KEYS).agg(
        F.count("*").alias("frames_used"), F.count_if(~F.col("complete")).alias("incomplete_frames"), F.sum("filled").alias("imu_points_filled")
    )


def _seconds_by(rows: DataFrame, key: Column, out: str) -> DataFrame:
    """Seconds per value of a column as a map; the small number of values is counted before it is gathered."""
    counted = rows.where(key.isNotNull()).groupBy(*KEYS, key.alias("k")).agg(F.count("*").alias("n"), F.max("interval_s").alias("i"))
    entries = F.array_sort(F.collect_list(F.struct("k", half_even(F.col("n") * F.col("i"), 1).alias("s"))))
    return counted.groupBy(*KEYS).agg(F.map_from_entries(entries).alias(out))


def summarise(rows: DataFrame, order: list[str] | None = None, chunk: int = HOUR_US) -> DataFrame:
    """One row per session with every metric; durations in seconds, distances in km."""
    order = order or ["t_us"]
    motion = cut_lineage(with_motion(rows, order, chunk))
    step = F.max("interval_s")
    speed, rpm = F.col("speed_kph"), F.col("rpm")
    gear_in_d = (F.col("prndl") == "D") & F.col("gear").isNotNull()
    shift_d = gear_in_d & F.col("gear_held.g").isNotNull() & (F.col("gear") != F.col("gear_held.g"))
    shift_any = F.col("gear").isNotNull() & F.col("gear_before").isNotNull() & (F.col("gear") != F.col("gear_before"))
    main = motion.groupBy(*KEYS).agg(
        F.count("*").alias("rows"), step.alias("interval_s"), F.min("t_us").alias("started_us"),
        half_even((F.max("t_us") - F.min("t_us")) / F.lit(1e6) + step, 1).alias("duration_s"),
        half_even(F.count_if("moving") * step, 1).alias("moving_s"),
        half_even(F.count_if(~F.col("moving") & (rpm != 0)) * step, 1).alias("idle_s"),
        F.count_if(F.col("was_moving") & ~F.col("moving")).alias("stops"),
        half_even(F.coalesce(F.sum("gps_step_km"), F.lit(0.0)), 3).alias("distance_gps_km"),
        half_even(F.sum("speed_kph") * step / 3600, 3).alias("distance_can_km"),
        half_even(F.max("odometer_km") - F.min("odometer_km"), 3).alias("distance_odometer_km"),
        half_even(F.avg(F.when(F.col("moving"), speed)), 1).alias("avg_moving_kph"),
        half_even(F.max("speed_kph"), 1).alias("max_can_kph"), half_even(F.max("gps_speed_kph"), 1).alias("max_gps_kph"),
        half_even(F.max("rpm"), 0).alias("max_rpm"), half_even(F.avg(F.when(F.col("moving"), rpm)), 0).alias("avg_rpm_moving"),
        half_even(F.count_if(rpm > HIGH_RPM) * step, 1).alias("seconds_above_4000"),
        (F.count("prndl") > 0).alias("has_selector"),
        F.count_if(shift_d).alias("shifts_in_drive"), F.count_if(shift_any).alias("shifts_any"),
        F.count_if(F.col("braking") & ~F.coalesce("was_braking", F.lit(False))).alias("brake_applications"),
        half_even(F.count_if("braking") * step, 1).alias("brake_s"), half_even(F.max("brake_kpa"), 0).alias("max_brake_kpa"),
        half_even(F.min("lon_g"), 3).alias("peak_braking_g"), half_even(F.max("lon_g"), 3).alias("peak_acceleration_g"),
        half_even(F.max("lat_g"), 3).alias("peak_lateral_g"),
        _span("coolant_c", order).alias("coolant_c"), _span("oil_temp_c", order).alias("oil_temp_c"),
        F.count_if(F.coalesce("gps_fixes", F.lit(0)) == 0).alias("intervals_without_gps"),
        *[F.count(c).alias(f"_n_{c}") for c in ROLE_COLUMNS],
    )
    absent = F.filter(F.array(*[F.when(F.col(f"_n_{c}") == 0, c) for c in ROLE_COLUMNS]), lambda c: c.isNotNull())
    main = main.withColumn("roles_unavailable", absent).withColumn(
        "shifts", F.when(F.col("has_selector"), F.col("shifts_in_drive")).otherwise(F.col("shifts_any"))
    ).drop("shifts_in_drive", "shifts_any", *[f"_n_{c}" for c in ROLE_COLUMNS])
    driven = motion.join(main.select(*KEYS, "has_selector"), KEYS)
    gear = F.when(F.when(F.col("has_selector"), F.col("prndl") == "D").otherwise(True), F.col("gear").cast("int"))
    parts = [
        event_runs(motion, order, chunk),
        frame_quality(rows, order),
        _seconds_by(motion, F.col("prndl"), "selector_s"),
        _seconds_by(driven, gear, "gears_s"),
    ]
    out = main.withColumn("version", F.lit(VERSION))
    for part in parts:
        out = out.join(part, KEYS, "left")
    return out


def nearest_rank(values: DataFrame, keys: list[str], value: str, ranks: dict[str, Callable[[Column], Column]], bucket: int) -> DataFrame:
    """Exact order statistics of a LONG column per key: `ranks` gives each one's rank from the number of values. Equal
    values are counted first and the counts accumulated in value buckets, so a key with most of the rows is never
    gathered in one task."""
    counted = cut_lineage(values.groupBy(*keys, value).agg(F.count("*").alias("n")))
    cumulative = scan(counted, keys, [value], {"upto": running_sum(F.col("n"))}, bucket)
    total = counted.groupBy(*keys).agg(F.sum("n").alias("total"))
    placed = cumulative.join(total, keys)
    return placed.groupBy(*keys).agg(
        F.max("total").alias("n"),
        *[F.min(F.when(F.col("upto") >= rank(F.col("total")), F.col(value))).alias(name) for name, rank in ranks.items()],
        F.max(value).alias("max"),
    )


def at_share(p: float) -> Callable[[Column], Column]:
    """Nearest rank of a share: the smallest rank at or above p * n, at least one."""
    return lambda n: F.greatest(F.lit(1), F.ceil(F.lit(p) * n))


def frame_lags(rows: DataFrame, order: list[str], keys: list[str] = KEYS) -> DataFrame:
    """Per frame, from its last row that has both times: upload lag (received minus the frame's end) and pipeline lag
    (written minus received), in microseconds."""
    timed = F.when(F.col("received_us").isNotNull() & F.col("written_us").isNotNull(), F.struct(*order))
    per_frame = rows.groupBy(*keys, "frame_base_us").agg(F.max_by(F.struct("received_us", "written_us"), timed).alias("w"))
    return per_frame.where("w IS NOT NULL").select(
        *keys, "frame_base_us",
        (F.col("w.received_us") - (F.col("frame_base_us") + FRAME_US)).alias("upload_us"),
        (F.col("w.written_us") - F.col("w.received_us")).alias("pipeline_us"),
    )


def processing(rows: DataFrame, order: list[str], bucket_us: int = 1_000_000) -> DataFrame:
    """p50, p95 and max of both lags per session, in seconds."""
    lags = frame_lags(rows, order)
    ranks = {"p50": at_share(0.5), "p95": at_share(0.95)}
    out = None
    for name in ("upload", "pipeline"):
        q = nearest_rank(lags, KEYS, f"{name}_us", ranks, bucket_us)
        q = q.select(*KEYS, F.col("n").alias("frames_timed") if out is None else F.col("n").alias("_n"),
                     *[half_even(F.col(c) / F.lit(1e6), 1).alias(f"{name}_{c}_s") for c in ("p50", "p95", "max")])
        out = q if out is None else out.join(q.drop("_n"), KEYS)
    return out
