"""Route rows of a drive and their runs by colour band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.rounding import half_even
from roadlake.functions.geo import haversine_km
from roadlake.functions.units import KM_PER_MILE
from roadlake.operators.ordered import HOUR_US, number_runs, prev, scan

KEYS = ["session", "device"]
MAX_GAP_S = 5.0
NO_VALUE = "no value"

# Upper bounds and labels of the bands.
SPEED_MPH_BANDS = ((20 * KM_PER_MILE, "<20"), (40 * KM_PER_MILE, "20-40"), (55 * KM_PER_MILE, "40-55"), (None, "55+"))
SPEED_KPH_BANDS = ((30.0, "<30"), (60.0, "30-60"), (90.0, "60-90"), (None, "90+"))
THROTTLE_BANDS = ((10.0, "<10%"), (30.0, "10-30%"), (60.0, "30-60%"), (None, "60%+"))
BRAKE_BANDS = ((20.0, "off"), (70.0, "light"), (110.0, "medium"), (150.0, "firm"), (None, "hard"))
RPM_BANDS = ((1500.0, "<1500"), (2500.0, "1500-2500"), (3500.0, "2500-3500"), (None, "3500+"))


def route_rows(states: DataFrame) -> DataFrame:
    """Located rows: seconds from the session's first row, CAN speed or else GPS speed, one decimal."""
    first = states.groupBy(*KEYS).agg(F.min("t_us").alias("_t0"))

    def one(name: str) -> Column:
        return half_even(F.col(name), 1).alias(name)

    located = states.join(first, KEYS).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return located.select(
        *KEYS, "t_us", "event_id", half_even((F.col("t_us") - F.col("_t0")) / F.lit(1e6), 1).alias("s"), "lat", "lon",
        half_even(F.coalesce("speed_kph", "gps_speed_kph"), 1).alias("speed_kph"), one("rpm"), one("throttle_pct"), "brake_on", one("gear"), "prndl", one("brake_kpa"),
    )


def _banded(value: Column, bands) -> Column:
    out = F.lit(bands[-1][1])
    for bound, label in reversed(bands[:-1]):
        out = F.when(value < bound, label).otherwise(out)
    return F.when(value.isNotNull(), out)


def band(by: str, imperial: bool = True) -> Column:
    """A point's band; "no value" where the vehicle gives none."""
    selector, gear = F.col("prndl"), F.col("gear")
    choices = {
        "speed": lambda: _banded(F.col("speed_kph"), SPEED_MPH_BANDS if imperial else SPEED_KPH_BANDS),
        "throttle": lambda: _banded(F.col("throttle_pct"), THROTTLE_BANDS),
        "brake": lambda: F.coalesce(_banded(F.col("brake_kpa"), BRAKE_BANDS), F.when(F.col("brake_on"), "on").when(~F.col("brake_on"), "off")),
        "gear": lambda: F.when(selector != "D", selector).when(gear.between(1.0, 10.0), gear.cast("int").cast("string")),
        "rpm": lambda: _banded(F.col("rpm"), RPM_BANDS),
    }
    return F.coalesce(choices[by](), F.lit(NO_VALUE))


def band_points(route: DataFrame, by: str, order: list[str], imperial: bool = True, chunk: int = HOUR_US) -> DataFrame:
    """Points with their `run`. A run ends at a band change or a gap; the point of a band change belongs to both."""
    banded = route.withColumn("band", band(by, imperial))
    value = F.struct("s", "band")

    def gap(p, c):
        return c["s"] - p["s"] > MAX_GAP_S

    numbered = number_runs(banded, KEYS, order, value, lambda p, c: gap(p, c) | (p["band"] != c["band"]), "run", chunk)
    before = F.col("run_prev")
    shared = before.isNotNull() & ~gap(before, F.struct("s")) & (before["band"] != F.col("band"))
    own = F.struct(F.col("run").alias("run"), F.col("band").alias("band"))
    also = F.when(shared, F.struct((F.col("run") - 1).alias("run"), before["band"].alias("band")))
    both = F.filter(F.array(own, also), lambda r: r.isNotNull())
    kept = [c for c in route.columns]
    return numbered.select(*kept, F.explode(both).alias("r")).select(*kept, "r.run", "r.band")


def band_runs(points: DataFrame) -> DataFrame:
    """Runs of two points or more with their extent."""
    runs = points.groupBy(*KEYS, "run", "band").agg(
        F.count("*").alias("points"), F.min("s").alias("from_s"), F.max("s").alias("to_s"),
        F.min("lat").alias("south"), F.min("lon").alias("west"), F.max("lat").alias("north"), F.max("lon").alias("east"),
    )
    return runs.where("points >= 2")


def trip_distance(fixes: DataFrame, order: list[str], max_accuracy_m: float = 25.0, moving_mps: float = 1.0, chunk: int = HOUR_US) -> DataFrame:
    """Metres per session between accurate fixes, counted only where the later one is moving."""
    accurate = fixes.where(F.col("accuracy_m") <= max_accuracy_m)
    seen = scan(accurate, KEYS, order, {"before": prev(F.struct("lat", "lon"))}, chunk)
    moving = F.coalesce("speed_mps", F.lit(0.0)) >= moving_mps
    step = haversine_km(F.col("before.lat"), F.col("before.lon"), F.col("lat"), F.col("lon")) * 1000.0
    return seen.groupBy(*KEYS).agg(F.coalesce(F.sum(F.when(moving, step)), F.lit(0.0)).alias("distance_m"))
