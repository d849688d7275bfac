"""CAN decode on a stream, against dimension tables that are read again for every micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from roadlake.operators import decode
from roadlake.session import cut_lineage

SIGNALS, OUTCOMES = "signals", "outcomes"


@dataclass(frozen=True)
class Dimensions:
    """How to read the tables a frame is resolved by. Called for each micro-batch, so that a session, vehicle or DBC that has been
    added or changed since counts from the next micro-batch on; a static side of a streaming join is listed but once."""

    sessions: Callable[[SparkSession], DataFrame]
    vehicles: Callable[[SparkSession], DataFrame]
    dbcs: Callable[[SparkSession], DataFrame]
    dbc_signals: Callable[[SparkSession], DataFrame]


def write_decoded(frames: DataFrame, batch_id: int, dimensions: Dimensions, folder: str) -> None:
    """One micro-batch: frames with dbc, outcome and reason to `outcomes`, and the values of decoded ones to `signals`. Both
    tables are partitioned by micro-batch, and a micro-batch that is run again replaces its own partition."""
    spark = frames.sparkSession
    signals = dimensions.dbc_signals(spark)
    resolved = decode.resolve_dbc(frames, dimensions.sessions(spark), dimensions.vehicles(spark), dimensions.dbcs(spark))
    judged = cut_lineage(decode.classify(resolved, signals))
    values = decode.decode(judged.where("outcome = 'decoded'").drop("message", "outcome", "reason"), signals)
    for rows, name in ((judged, OUTCOMES), (values, SIGNALS)):
        rows.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")


def decode_stream(frames: DataFrame, dimensions: Dimensions, folder: str, checkpoint: str):
    """A streaming query that decodes `frames` (session, device, can_id, data_hex and any others) into the tables `outcomes` and
    `signals` under `folder`, for every micro-batch by the dimensions of its time. Frames of a session that is not known
    yet are kept with the outcome `dropped` and their reason, so they can be found and decoded later."""
    return frames.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda rows, k: write_decoded(rows, k, dimensions, folder))
