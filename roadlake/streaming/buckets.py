"""Streams that need no custom state: per-second buckets with grace, first-wins de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRACE = "1500 milliseconds"


def second_buckets(samples: DataFrame, grace: str = GRACE) -> DataFrame:
    """Counts per device, second and kind; a second closes once event time is 1.5 s past it, older samples are dropped."""
    timed = samples.withColumn("event_time", F.timestamp_micros("t_us")).withWatermark("event_time", grace)
    counted = timed.groupBy("device", F.window("event_time", "1 second").alias("w")).agg(
        F.count("*").alias("samples"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("can", "imu", "gps")]
    )
    return counted.select("device", F.unix_micros("w.start").alias("second_us"), "samples", "n_can", "n_imu", "n_gps")


def first_in_stream(rows: DataFrame, keys: list[str], time: str, horizon: str) -> DataFrame:
    """First record of each key; keys are forgotten once event time is `horizon` past them, so state stays bounded."""
    timed = rows.withColumn("event_time", F.timestamp_micros(time)).withWatermark("event_time", horizon)
    return timed.dropDuplicatesWithinWatermark(keys).drop("event_time")
