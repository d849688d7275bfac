"""Unwrapping message envelopes and extracting the fields the derivations need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.clock import iso_us
from roadlake.functions.text import blank_to_null


def unwrap(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add `record` (the flat JSON record as text) and `headers` (JSON text, null without any).

    A record with a device at the top is already flat; otherwise it is the envelope's body, or its base64 payload;
    anything else passes through unchanged.
    """
    v = F.col(value)
    flat = F.get_json_object(v, "$.device_id").isNotNull()
    has_headers = F.get_json_object(v, "$.headers").startswith("{")
    body = F.get_json_object(v, "$.body")
    packed = F.get_json_object(v, "$.payload_b64")
    wrapped = ~flat & has_headers & (body.isNotNull() | packed.isNotNull())
    record = F.when(wrapped, F.coalesce(body, F.decode(F.unbase64(packed), "UTF-8"))).otherwise(v)
    return messages.select("*", record.alias("record"), F.when(wrapped, F.get_json_object(v, "$.headers")).alias("headers"))


def number(record: Column, path: str) -> Column:
    """A numeric field by dot path; null when any step is missing or the leaf is not a number."""
    return F.try_variant_get(F.try_parse_json(record), f"$.{path}", "double")


def event_time_us(captured: Column, received: Column) -> Column:
    """Capture time, else receive time; blank counts as missing."""
    return iso_us(F.coalesce(blank_to_null(captured), blank_to_null(received)))


def required(df: DataFrame, fields: list[str]) -> DataFrame:
    """Add `missing`, the first required field that is null or blank, null for complete rows."""
    reason = F.lit(None).cast("string")
    for name in reversed(fields):
        text = df.schema[name].dataType.simpleString() == "string"
        absent = (blank_to_null(F.col(name)) if text else F.col(name)).isNull()
        reason = F.when(absent, name).otherwise(reason)
    return df.withColumn("missing", reason)


# What each derivation needs.
SPEED_FIELDS = ["device", "session", "speed", "t_us"]
POSITION_FIELDS = ["device", "session", "t_us", "lat", "lon"]
TRACK_FIELDS = ["device", "session", "t_us", "track_id", "track_name", "s_m"]
