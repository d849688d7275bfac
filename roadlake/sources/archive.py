"""The message archive: normalised rows, the partitioned Parquet sink, and reading a session back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.clock import iso_us
from roadlake.functions.text import path_part

# Records and seconds per file, and how far before a session's start a replay begins.
MAX_RECORDS_PER_FILE = 250
MAX_SECONDS_PER_FILE = 30
REPLAY_LEAD_US = 5 * 60 * 1_000_000
PARTITIONS = ["topic", "source_session", "event_date", "event_hour"]


def _iso(us: Column) -> Column:
    """ISO text with Z; microseconds only when there are any."""
    ts = F.timestamp_micros(us)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(us % 1_000_000 == 0, whole).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def normalise(messages: DataFrame) -> DataFrame:
    """`messages`: topic, headers (map), payload_json, archived_us. The event time is the capture time, else the receive
    time, else the archive time. `event_us` is kept for pruning."""
    p = F.col("payload_json")

    def text(name: str) -> Column:
        return F.get_json_object(p, f"$.{name}")

    def filled(name: str) -> Column:
        return F.nullif(text(name), F.lit(""))

    event = F.coalesce(iso_us(F.coalesce(filled("captured_at"), filled("received_at"))), F.col("archived_us"))
    headers = F.map_from_entries(F.array_sort(F.map_entries("headers")))
    return messages.select(
        "topic", F.coalesce(filled("device_id"), F.lit("unknown-device")).alias("device_id"),
        F.coalesce(filled("source_session"), F.lit("unknown-session")).alias("source_session"),
        *[text(c).alias(c) for c in ("captured_at", "received_at", "message_type", "source")],
        F.date_format(F.timestamp_micros(event), "yyyy-MM-dd").alias("event_date"), F.date_format(F.timestamp_micros(event), "HH").alias("event_hour"),
        _iso(event).alias("event_timestamp"), event.alias("event_us"), _iso(F.col("archived_us")).alias("archived_at"),
        F.to_json(headers).alias("headers_json"), p.alias("payload_json"),
    )


def _parts(records: DataFrame) -> DataFrame:
    """Partition columns with path-safe names; the record's own session stays beside the partition's."""
    return records.withColumn("session", F.col("source_session")).withColumn("topic", path_part(F.col("topic"))).withColumn(
        "source_session", path_part(F.col("source_session"))
    )


def write_archive(records: DataFrame, path: str, bytes_per_file: int = 128 << 20) -> None:
    """Batch write in files of about `bytes_per_file`. Rows are dealt by partition, and Spark splits a partition that is
    larger than that over several tasks and joins small ones, so neither a hot session nor many quiet ones matter."""
    dealt = _parts(records).hint("rebalance", *PARTITIONS)
    size = F.sum(F.octet_length("payload_json") + F.octet_length("headers_json"))
    totals = records.agg(size.alias("bytes"), F.count("*").alias("n")).first()
    per_record = max(1, (totals["bytes"] or 0) // max(1, totals["n"]))
    dealt.write.mode("append").option("maxRecordsPerFile", max(1, bytes_per_file // per_record)).option("compression", "snappy").partitionBy(*PARTITIONS).parquet(path)


def archive_stream(records: DataFrame, path: str, checkpoint: str, available_now: bool = False, records_per_file: int = MAX_RECORDS_PER_FILE, seconds_per_file: int = MAX_SECONDS_PER_FILE):
    """Streaming sink: a file per partition every `seconds_per_file` seconds or `records_per_file` records."""
    writer = (
        _parts(records).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", records_per_file).option("compression", "snappy").partitionBy(*PARTITIONS)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds_per_file} seconds"}
    return writer.trigger(**trigger).start()


def replay_session(archive: DataFrame, session: str, device: str, started_us: int, lead_us: int = REPLAY_LEAD_US) -> DataFrame:
    """A session's records from five minutes before its start: the date filter prunes partitions, the rest rows."""
    since = started_us - lead_us
    day = F.date_format(F.timestamp_micros(F.lit(since)), "yyyy-MM-dd")
    return archive.where(
        (F.col("source_session") == path_part(F.lit(session))) & (F.col("event_date") >= day) & (F.col("event_us") >= since)
        & (F.col("session") == session) & (F.col("device_id") == device)
    )


def replay_sessions(records: DataFrame, sessions: DataFrame, lead_us: int = REPLAY_LEAD_US) -> DataFrame:
    """The same for many sessions (source_session, device_id, started_us) in one join."""
    return records.join(sessions, ["source_session", "device_id"]).where(F.col("event_us") >= F.col("started_us") - lead_us).drop("started_us")
