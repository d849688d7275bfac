"""What the text operators share: reading tables, UTF-8 buffers of Arrow columns, and batches of bounded bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting that the files of a query's shuffles go when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the folder that the cluster shares: computed once, read by columns, and joined as a scan,
    whose shuffled partitions adaptive execution can split where one key is crowded. The shuffles it took leave the disk."""
    spark = df.sparkSession
    path, before = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}", spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def drop(*tables: DataFrame) -> None:
    """Deletes tables that `written` gave, once no plan reads them any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, number: str) -> DataFrame:
    """`df` with a row number as the column `number`, written: a number made anew by another job may belong to another row,
    since the splits of a scan follow the cores that are there at the time."""
    return written(df.withColumn(number, F.monotonically_increasing_id()))


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names, so that no other column can clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *(F.col(f"`{c}`") for c in more))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; row i is bytes[offsets[i]:offsets[i + 1]], null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about `limit` bytes of text; a longer single row is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()  # workers live on; what a task has freed should not stay with them


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set within each row's bytes."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def rebased(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same rows with the bytes before and after them cut off."""
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_set(values: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


def word_starts(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags of bytes that begin a word, where `inside` flags word bytes; words end with their row."""
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    first = offsets[:-1]
    before[first[first < len(inside)]] = False
    return inside & ~before


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
