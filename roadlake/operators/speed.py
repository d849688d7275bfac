"""Average speed per device over tumbling event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = "10 seconds"
OUT_OF_ORDER = "5 seconds"


def _windowed(samples: DataFrame, window: str, latest) -> DataFrame:
    grouped = samples.groupBy("device", F.window("event_time", window).alias("w")).agg(
        F.avg("speed").alias("average_speed"), F.count("*").alias("samples"), F.max_by("session", latest).alias("session")
    )
    return grouped.select(
        "device",
        F.unix_micros("w.start").alias("window_start_us"),
        F.unix_micros("w.end").alias("window_end_us"),
        "average_speed", "samples", "session",
    )


def average_speed(samples: DataFrame, window: str = WINDOW) -> DataFrame:
    """`samples`: device, session, event_id, t_us, speed. The session is the latest sample's."""
    return _windowed(samples.withColumn("event_time", F.timestamp_micros("t_us")), window, F.struct("t_us", "event_id"))


def average_speed_stream(samples: DataFrame, window: str = WINDOW, lateness: str = OUT_OF_ORDER) -> DataFrame:
    """The same on a stream: windows close once the watermark passes, later rows are dropped."""
    timed = samples.withColumn("event_time", F.timestamp_micros("t_us")).withWatermark("event_time", lateness)
    return _windowed(timed, window, F.struct("t_us", "event_id"))
