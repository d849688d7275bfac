"""Bad position fixes: poor quality by their own figures, and jumps that no vehicle makes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.operators.ordered import HOUR_US, chunked_fold

KEYS = ["session", "device"]

# Defaults of our own: what a usable fix reports, the fastest believable speed, fixes that agree before a jump is believed.
MAX_HDOP, MIN_SATELLITES = 5.0, 4
MAX_KPH = 400.0
AGREEING = 5
EARTH_M = 6_371_000.0


def quality(max_hdop: float = MAX_HDOP, min_satellites: int = MIN_SATELLITES) -> Column:
    """Why a fix is refused by its own figures, null where it is not; what is not reported is not held against it."""
    return F.when(F.col("lat").isNull() | F.col("lon").isNull(), "NO_POSITION").when(F.col("hdop") > max_hdop, "POOR_HDOP").when(F.col("num_sats") < min_satellites, "FEW_SATELLITES")


def _metres(lat1, lon1, lat2, lon2):
    dy, dx = math.radians(lat2 - lat1) / 2, math.radians(lon2 - lon1) / 2
    h = math.sin(dy) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(dx) ** 2
    return 2 * EARTH_M * math.asin(math.sqrt(min(1.0, h)))


def _gate(max_kph: float, agreeing: int):
    """Fold step. `at` is the last accepted fix, `other` the last refused one and `run` how many refused ones in a row agree with
    each other; as many as `agreeing` in a row are where the vehicle is, and the gate opens there."""

    def near(fix, t, lat, lon):
        return _metres(fix[1], fix[2], lat, lon) * 3.6e6 <= max_kph * max(t - fix[0], 0)

    def step(rows, state):
        at, other, run = (state["at"], state["other"], state["run"]) if state else (None, None, 0)
        passed = []
        for t, lat, lon in zip(rows["t_us"].tolist(), rows["lat"].tolist(), rows["lon"].tolist()):
            ok = at is None or near(at, t, lat, lon)
            if not ok:
                run = run + 1 if other is not None and near(other, t, lat, lon) else 1
                other, ok = [t, lat, lon], run >= agreeing
            if ok:
                at, other, run = [t, lat, lon], None, 0
            passed.append(ok)
        return passed, {"at": at, "other": other, "run": run}

    return step


def judge_fixes(fixes: DataFrame, order: list[str], keys: list[str] = KEYS, max_hdop: float = MAX_HDOP, min_satellites: int = MIN_SATELLITES, max_kph: float = MAX_KPH, agreeing: int = AGREEING,
                chunk: int = HOUR_US) -> DataFrame:
    """Every fix with `reason`, null for those to use. `fixes`: keys, the columns of `order` (t_us first), lat, lon, hdop, num_sats.

    A fix that would need more than `max_kph` from the last one accepted is an IMPOSSIBLE_JUMP: drift in a garage stays out,
    for however long, and a gap makes room for the distance driven meanwhile. If the accepted one was itself wrong, the
    gate opens again at the fix that is the `agreeing`-th in a row to follow from the one before. Fixes of poor quality are
    not gone by. Rows that differ in nothing of keys and order are judged alike."""
    judged = fixes.withColumn("reason", quality(max_hdop, min_satellites))
    usable = judged.where(F.col("reason").isNull())
    refused = chunked_fold(usable, keys, order, ["lat", "lon"], _gate(max_kph, agreeing), "ok", "boolean", chunk).where(~F.col("ok"))
    on = [*keys, *order]
    return judged.join(refused.select(*on, F.lit("IMPOSSIBLE_JUMP").alias("_jump")).distinct(), on, "left").withColumn("reason", F.coalesce("reason", "_jump")).drop("_jump")
