"""As-of joins: hold, linear interpolation and nearest, of samples onto the times of a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.operators.ordered import HOUR_US, first_known, last_known, scan


def bracket(
    grid: DataFrame, samples: DataFrame, keys: list[str], time: str, tie: str, value: Column, chunk: int, grid_first: bool
) -> DataFrame:
    """Every grid row with the sample before and after it (structs of time and value).

    Both sides are unioned and scanned together: one shuffle, and no pair of a grid row and a sample is ever formed.
    A sample at a grid row's own time counts as before it, or as after it with `grid_first`."""
    at_grid, at_sample = (0, 1) if grid_first else (1, 0)
    seen = F.struct(F.col(time).alias("t"), value.alias("v"))
    extra = [c for c in grid.columns if c not in (*keys, time)]
    left = grid.select(*keys, time, F.lit(at_grid).alias("_k"), F.lit(0).cast("long").alias("_tie"), F.struct(*extra, F.lit(1).alias("_g")).alias("_row"))
    right = samples.select(*keys, time, F.lit(at_sample).alias("_k"), F.col(tie).cast("long").alias("_tie"), seen.alias("_s"))
    both = left.unionByName(right, allowMissingColumns=True)
    # several grid rows may share a time, so the order ends in a number of their own
    both = both.withColumn("_u", F.when(F.col("_row").isNotNull(), F.xxhash64("_row")).otherwise(F.lit(0).cast("long")))
    out = scan(both, keys, [time, "_k", "_tie", "_u"],
               {"before": last_known(F.col("_s"), inclusive=False), "after": first_known(F.col("_s"), inclusive=False)}, chunk)
    return out.where("_row IS NOT NULL").select(*keys, time, *[F.col("_row")[c].alias(c) for c in extra], "before", "after")


def hold(grid: DataFrame, samples: DataFrame, keys: list[str], time: str, tie: str, value: Column, out: str, chunk: int = HOUR_US) -> DataFrame:
    """The latest sample at or before each grid time; null before the first."""
    rows = bracket(grid, samples, keys, time, tie, value, chunk, grid_first=False)
    return rows.withColumn(out, F.col("before.v")).drop("before", "after")


def interpolate(grid: DataFrame, samples: DataFrame, keys: list[str], time: str, tie: str, value: Column, out: str, chunk: int = HOUR_US) -> DataFrame:
    """The value between the samples around each grid time, clamped to the first and last sample."""
    rows = bracket(grid, samples, keys, time, tie, value, chunk, grid_first=False)
    a, b = F.col("before"), F.col("after")
    between = a["v"] + (F.col(time) - a["t"]) / F.nullif(b["t"] - a["t"], F.lit(0)) * (b["v"] - a["v"])
    return rows.withColumn(out, F.when(a.isNull(), b["v"]).when(b.isNull(), a["v"]).otherwise(F.coalesce(between, a["v"]))).drop("before", "after")


def nearest(grid: DataFrame, samples: DataFrame, keys: list[str], time: str, tie: str, value: Column, out: str, chunk: int = HOUR_US) -> DataFrame:
    """The sample nearest in time, the earlier on a tie, with `<out>_gap`, its distance."""
    rows = bracket(grid, samples, keys, time, tie, value, chunk, grid_first=True)
    back, ahead = F.col(time) - F.col("before.t"), F.col("after.t") - F.col(time)
    pick = F.when(F.col("after").isNull() | (back <= ahead), F.col("before")).otherwise(F.col("after"))
    return rows.withColumn("_p", pick).withColumn(out, F.col("_p.v")).withColumn(f"{out}_gap", F.abs(F.col("_p.t") - F.col(time))).drop("before", "after", "_p")
