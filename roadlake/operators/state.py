"""Vehicle state: frame completeness, interval statistics, last values, and signals carried forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.operators.frames import LIVE_SESSION
from roadlake.operators.ordered import HOUR_US, next_, running_sum, scan
from roadlake.session import cut_lineage

KEYS = ["session", "device"]
SAMPLE_KINDS = ("gps", "imu", "can", "unknown", "discovery")
FRAME_US = 1_000_000


def eligibility(closed_upto: Column) -> Column:
    """Why a record cannot join a frame: no session, untagged, or late; null when it can."""
    blank = F.coalesce(F.trim("session"), F.lit("")).isin("", LIVE_SESSION) | (F.coalesce(F.trim("device"), F.lit("")) == "")
    return (
        F.when(blank, "no session")
        .when(F.col("base_us").isNull(), "untagged")
        .when(F.col("base_us") <= F.coalesce(closed_upto, F.lit(-1)), "late")
    )


def frame_status(samples: DataFrame, receipts: DataFrame) -> DataFrame:
    """One row per frame: counts per kind, receipt, `status`. `samples`: keys, base_us, kind, received_us.

    The outer join of five sample streams with the receipts is one grouping of their union, which combines map-side
    and needs one shuffle."""
    empty = [F.lit(None).cast("long").alias(f"sent_{k}") for k in ("gps", "imu", "can")]
    rows = samples.select(*KEYS, "base_us", "kind", "received_us", *empty, F.lit(None).cast("long").alias("imu_missing")).unionByName(
        receipts.select(
            *KEYS, "base_us", F.lit("session").alias("kind"), "received_us",
            *[F.col(k).cast("long").alias(f"sent_{k}") for k in ("gps", "imu", "can")], F.col("imu_missing").cast("long").alias("imu_missing"),
        )
    )
    counted = rows.groupBy(*KEYS, "base_us").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in SAMPLE_KINDS],
        F.count_if(F.col("kind") == "session").alias("n_receipts"),
        *[F.max(c).alias(c) for c in ("sent_gps", "sent_imu", "sent_can", "imu_missing", "received_us")],
    )
    matches = (
        (F.col("n_gps") == F.coalesce("sent_gps", F.lit(0)))
        & (F.col("n_imu") == F.coalesce("sent_imu", F.lit(0)))
        & (F.col("n_can") + F.col("n_unknown") + F.col("n_discovery") == F.coalesce("sent_can", F.lit(0)))
    )
    any_sample = sum((F.col(f"n_{k}") for k in SAMPLE_KINDS), F.lit(0)) > 0
    status = F.when((F.col("n_receipts") > 0) & matches, "complete").when(any_sample, "incomplete").otherwise("empty")
    return counted.withColumn("status", status)


def place(samples: DataFrame, interval_us: int, frame_us: int = FRAME_US) -> DataFrame:
    """Add `start_us`, the interval of the sample's frame. Early samples count in the first interval; those past the
    frame's end in none."""
    offset = F.col("t_us") - F.col("base_us")
    index = F.greatest(F.lit(0), F.floor(offset / interval_us))
    return samples.where(offset < frame_us).withColumn("start_us", F.col("base_us") + index * interval_us)


def intervals(frames: DataFrame, interval_us: int, frame_us: int = FRAME_US) -> DataFrame:
    """Every interval of every frame."""
    last = (frame_us + interval_us - 1) // interval_us - 1
    return frames.select("*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("_i")).select(
        *frames.columns, (F.col("base_us") + F.col("_i") * interval_us).alias("start_us")
    )


def signal_intervals(placed: DataFrame) -> DataFrame:
    """Per interval and signal: min, max, mean, count, the last value by sample time and when it was seen."""
    return placed.where(F.col("value").isNotNull()).groupBy(*KEYS, "base_us", "start_us", "signal").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.count("*").alias("count"),
        F.max_by("value", F.struct("t_us", "seq")).alias("last"), F.max("t_us").alias("seen_us"),
    )


AXES = ("x", "y", "z")


def axis_stats(column: str) -> list[Column]:
    """Mean, min and max per axis, each as a struct of three; null without samples."""
    out = []
    for name, fn in (("mean", F.avg), ("min", F.min), ("max", F.max)):
        values = F.struct(*[fn(F.col(column)[a]).alias(a) for a in AXES])
        out.append(F.when(F.count(column) > 0, values).alias(f"{column}_{name}"))
    return out


def motion_intervals(placed: DataFrame) -> DataFrame:
    """Per interval: the last fix and the number of fixes, IMU axis statistics and the number of samples. GPS and IMU
    rows arrive in one union and are folded in one grouping."""
    fix = F.when(F.col("fix").isNotNull(), F.struct("t_us", "seq"))
    return placed.groupBy(*KEYS, "base_us", "start_us").agg(
        F.max_by("fix", fix).alias("fix"), F.count("fix").alias("gps_fixes"),
        *axis_stats("accel"), *axis_stats("gyro"), F.count("accel").alias("imu_samples"),
    )


def carry_forward(rows: DataFrame, seen: DataFrame, interval_us: int, chunk: int = HOUR_US, block: int = 4096) -> DataFrame:
    """Per interval: `signals`, every signal seen so far in the session with its latest value, and `carried`, the age
    in ms of those not seen in this interval.

    Rows are numbered per session; an observation holds until the next one of its signal. Its span is cut into blocks
    before it is expanded, so a signal seen once in a long session is spread over many tasks."""
    numbered = cut_lineage(
        scan(rows.select(*KEYS, "base_us", "start_us"), KEYS, ["start_us", "base_us"], {"n": running_sum(F.lit(1).cast("long"))}, chunk)
    )
    ends = numbered.groupBy(*KEYS).agg(F.max("n").alias("n_last"))
    placed = cut_lineage(
        seen.select(*KEYS, "base_us", "start_us", "signal", "last", "seen_us").join(numbered, [*KEYS, "base_us", "start_us"])
    )
    spans = scan(placed, [*KEYS, "signal"], ["start_us", "base_us"], {"n_next": next_(F.col("n"))}, chunk).join(ends, KEYS)
    until = F.coalesce(F.col("n_next") - 1, F.col("n_last"))
    pieces = spans.select(
        *KEYS, "signal", "last", "seen_us", "n", until.alias("until"),
        F.explode(F.sequence(F.floor(F.col("n") / block), F.floor(until / block))).alias("b"),
    ).repartition(*KEYS, "signal", "b")
    first = F.greatest(F.col("n"), F.col("b") * block)
    last = F.least(F.col("until"), F.col("b") * block + (block - 1))
    held = pieces.select(*KEYS, "signal", "last", "seen_us", F.explode(F.sequence(first, last)).alias("n"))
    maps = held.groupBy(*KEYS, "n").agg(F.array_sort(F.collect_list(F.struct("signal", "last", "seen_us"))).alias("e"))
    joined = numbered.join(maps, [*KEYS, "n"], "left")
    entries = F.coalesce(F.col("e"), F.array().cast("array<struct<signal:string,last:double,seen_us:bigint>>"))
    old = F.filter(entries, lambda x: x["seen_us"] < F.col("start_us"))
    end = F.col("start_us") + interval_us
    return joined.select(
        *KEYS, "base_us", "start_us",
        F.map_from_entries(F.transform(entries, lambda x: F.struct(x["signal"], x["last"]))).alias("signals"),
        F.map_from_entries(
            F.transform(old, lambda x: F.struct(x["signal"], F.floor((end - x["seen_us"]) / 1000)))
        ).alias("carried"),
    )


def vehicle_state(
    frames: DataFrame, can: DataFrame, motion: DataFrame, interval_us: int = FRAME_US, frame_us: int = FRAME_US, chunk: int = HOUR_US
) -> DataFrame:
    """State rows, one per interval of every closed frame that has samples.

    `frames`: keys, base_us, status (of `frame_status`). `can`: keys, base_us, t_us, seq, signal, value. `motion`: keys,
    base_us, t_us, seq, fix (struct), accel and gyro (structs of x, y, z), unioned from GPS and IMU."""
    rows = intervals(frames.where("status <> 'empty'").select(*KEYS, "base_us", (F.col("status") == "complete").alias("complete")),
                     interval_us, frame_us)
    per_signal = signal_intervals(place(can, interval_us, frame_us))
    stats = per_signal.groupBy(*KEYS, "base_us", "start_us").agg(
        F.map_from_entries(F.collect_list(F.struct("signal", F.struct("min", "max", "mean", "count")))).alias("signal_stats")
    )
    moved = motion_intervals(place(motion, interval_us, frame_us))
    carried = carry_forward(rows, per_signal, interval_us, chunk)
    on = [*KEYS, "base_us", "start_us"]
    return (
        rows.join(carried, on, "left").join(stats, on, "left").join(moved, on, "left")
        .withColumn("gps_fixes", F.coalesce("gps_fixes", F.lit(0)))
        .withColumn("imu_samples", F.coalesce("imu_samples", F.lit(0)))
    )
