"""Device-side sequences: clock alignment, IMU gaps, the 50 Hz grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlake.operators.ordered import prev, running_max, running_min, running_sum, scan
from roadlake.session import cut_lineage

# Drift allowed per second, silence that restarts the clock, and the grid.
DRIFT_MS_PER_S = 1.0
RESYNC_MS = 20_000
GAP_MS = 40
JUMP_MS = 10
SECOND_MS = 1000
IMU_PERIOD_MS = 20
QUAT_PERIOD_MS = 100
IMU_POINTS = 50
MAX_MISSING = 25


def signed_step(counter, before):
    """Difference of two 16-bit counters on their ring, in [-32768, 32767]."""
    return F.pmod(counter - before + 32768, F.lit(65536)) - 32768


def align_clock(
    lines: DataFrame, keys: list[str], order: list[str], chunk: int, drift: float = DRIFT_MS_PER_S, resync_ms: int = RESYNC_MS
) -> DataFrame:
    """Add `device_ms` and `placed_ms` to device lines (received_ms, counter, notification).

    The sequential estimator has a closed form: with device time d, its running maximum M and drift k, the offset after
    a line is k*M + running minimum of (received - d - k*M). So the clock is four running scans, restarted at silence."""
    line = lines.select(*keys, *order, "notification", "received_ms", "counter")
    heard = scan(line, keys, order, {"_heard": running_max(F.col("received_ms"), inclusive=False), "_before": prev(F.col("counter"))}, chunk)
    restart = F.col("_heard").isNull() | (F.col("received_ms") - F.col("_heard") > resync_ms)
    stepped = heard.withColumn("_r", restart.cast("long")).withColumn(
        "_step", F.when(restart, 0).otherwise(signed_step(F.col("counter"), F.col("_before"))).cast("long")
    )
    island = cut_lineage(scan(stepped, keys, order, {"_run": running_sum(F.col("_r")), "_cum": running_sum(F.col("_step"))}, chunk))
    within = [*keys, "_run"]
    start = island.groupBy(*within).agg(F.min_by("_cum", F.struct(*order)).alias("_start"))
    timed = island.join(start, within).withColumn("device_ms", F.col("_cum") - F.col("_start"))
    peaked = cut_lineage(scan(timed, within, order, {"_peak": running_max(F.col("device_ms"))}, chunk))
    allowed = F.col("_peak") * F.lit(drift / 1000.0)
    bound = scan(peaked, within, order, {"_low": running_min(F.col("received_ms") - F.col("device_ms") - allowed)}, chunk)
    bound = cut_lineage(bound.withColumn("_offset", allowed + F.col("_low")))
    # a notification's lines share the offset reached after its last line
    final = bound.groupBy(*within, "notification").agg(F.max_by("_offset", F.struct(*order)).alias("_final"))
    return bound.join(final, [*within, "notification"]).select(
        *line.columns, F.col("_run").alias("clock_run"), "device_ms", (F.col("device_ms") + F.col("_final").cast("long")).alias("placed_ms")
    )


def imu_gaps(samples: DataFrame, keys: list[str], order: list[str], chunk: int, gap_ms: int = GAP_MS, jump_ms: int = JUMP_MS) -> DataFrame:
    """Gaps in device time and jumps of the placed time, between consecutive samples that have a counter."""
    seen = scan(samples.where("counter IS NOT NULL"), keys, order, {"before": prev(F.struct("counter", "placed_ms"))}, chunk)
    step = signed_step(F.col("counter"), F.col("before.counter"))
    placed = F.col("placed_ms") - F.col("before.placed_ms")
    kind = F.when(step > gap_ms, "gap").when(F.abs(placed - step) > jump_ms, "clock_jump")
    return seen.withColumn("event", kind).where("event IS NOT NULL").select(
        *keys, *order, "event", "placed_ms", step.alias("device_step_ms"), F.when(F.col("event") == "clock_jump", placed).alias("placed_step_ms")
    )


def resample_imu(samples: DataFrame, keys: list[str], values: list[str], tie: str) -> tuple[DataFrame, DataFrame]:
    """(grid, seconds). Every second with samples gets fifty points, each the nearest sample of that second; a point
    farther than a period from it is missing; a second with more than 25 missing is dropped from the grid.
    `seconds` reports samples, missing points and the largest gap, edges included.

    A second is a group of its own, so all of it is plain windows over one shuffle by second."""
    second = F.col("t_ms") - F.pmod("t_ms", F.lit(SECOND_MS))
    placed = samples.withColumn("second_ms", second)
    within = [*keys, "second_ms"]
    points = placed.select(*within).distinct().select(*within, F.explode(F.sequence(F.lit(0), F.lit(IMU_POINTS - 1))).alias("point"))
    grid = points.withColumn("t_ms", F.col("second_ms") + F.col("point") * IMU_PERIOD_MS)
    left = grid.select(*within, "t_ms", F.lit(0).alias("_k"), F.lit(0).cast("long").alias("_tie"), "point")
    right = placed.select(*within, "t_ms", F.lit(1).alias("_k"), F.col(tie).cast("long").alias("_tie"), F.struct(F.col("t_ms").alias("t"), F.struct(*values).alias("v")).alias("_s"))
    both = left.unionByName(right, allowMissingColumns=True).repartition(*within)
    ordered = Window.partitionBy(*within).orderBy("t_ms", "_k", "_tie")
    whole = Window.partitionBy(*within).orderBy("t_ms", "_k", "_tie").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = both.select(
        "*", F.last("_s", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_s", ignorenulls=True).over(ordered.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    back, ahead = F.col("t_ms") - F.col("_before.t"), F.col("_after.t") - F.col("t_ms")
    pick = F.when(F.col("_after").isNull() | (back <= ahead), F.col("_before")).otherwise(F.col("_after"))
    at_grid = F.col("_k") == 0
    judged = seen.withColumn("_p", F.when(at_grid, pick)).withColumn("missing", F.abs(F.col("_p.t") - F.col("t_ms")) > IMU_PERIOD_MS)
    offset, previous = F.col("t_ms") - F.col("second_ms"), F.coalesce(F.col("_before.t") - F.col("second_ms"), F.lit(0))
    seconds = judged.groupBy(*within).agg(
        F.count("_s").alias("samples"),
        F.greatest(F.max(F.when(~at_grid, offset - previous)), F.lit(SECOND_MS) - F.max(F.when(~at_grid, offset))).alias("max_gap_ms"),
        F.count_if("missing").alias("missing_points"),
    ).withColumn("incomplete", F.col("missing_points") > MAX_MISSING)
    counted = judged.withColumn("_missing", F.count_if("missing").over(whole))
    kept = counted.where(at_grid & (F.col("_missing") <= MAX_MISSING)).select(*within, "t_ms", "point", F.col("_p.v").alias("sample"), "missing")
    quaternion = F.col("point") * IMU_PERIOD_MS % QUAT_PERIOD_MS == 0
    return kept.withColumn("has_quaternion", quaternion), seconds
