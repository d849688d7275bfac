"""Running a streaming plan over what is there now, into a Parquet table."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from roadlake.session import checkpoint_dir

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def work_dir(spark: SparkSession) -> str:
    """A new folder beside the checkpoints."""
    return f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


@contextmanager
def large_state(spark: SparkSession):
    """State kept in RocksDB, on disk rather than on the heap, as keyed state at scale needs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


ROWS_PER_FILE = 100_000
_PART = "_part"


def replayed(rows: DataFrame, arrival: str, batches: int = 6, files: int | None = None) -> DataFrame:
    """A recorded table as a stream of `batches` micro-batches, cut at equal steps of the number in column `arrival`.

    The rows are computed once and dealt by part. Each part is written to a folder in its turn, in `files` files (by default as many
    as its rows fill), and the stream takes that many files at a time, so state, watermarks and timers pass from batch to batch as
    they do on live traffic. A part of fewer rows than files gets empty ones, since a micro-batch must not reach into the next part."""
    spark, folder = rows.sparkSession, work_dir(rows.sparkSession)
    edge = rows.agg(F.min(arrival).alias("least"), F.max(arrival).alias("most"), F.count("*").alias("n")).first()
    step = (((edge["most"] or 0) - (edge["least"] or 0)) // batches + 1) if edge["least"] is not None else 1
    part = F.floor((F.col(arrival) - F.lit(edge["least"] or 0)) / step)
    files = files or edge["n"] // (batches * ROWS_PER_FILE) + 1
    dealt = work_dir(spark)
    rows.withColumn(_PART, part).write.partitionBy(_PART).parquet(dealt)
    parts = spark.read.schema(StructType([*rows.schema.fields, StructField(_PART, LongType())])).parquet(dealt)
    for k in range(batches):
        parts.where(F.col(_PART) == k).drop(_PART).repartition(files).write.mode("append").parquet(folder)
        for _ in range((k + 1) * files - len(spark.read.schema(rows.schema).parquet(folder).inputFiles())):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def run_to_table(stream: DataFrame, mode: str = "append", partition: list[str] | None = None) -> DataFrame:
    """Run to the end of the available input and return the table it wrote."""
    spark = stream.sparkSession
    folder = work_dir(spark)
    with large_state(spark):
        writer = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/log")
        if partition:
            writer = writer.partitionBy(*partition)
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
