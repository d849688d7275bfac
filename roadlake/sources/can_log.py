"""The fixed-width CAN log: 17-byte big-endian records (u32 ms, u32 id with an extended flag, u8 length, 8 bytes)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

RECORD_BYTES = 17
EXTENDED = 0x80000000


def misaligned_files(spark: SparkSession, path: str) -> DataFrame:
    """Files whose size is not a whole number of records. Only file metadata is read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.where(F.col("length") % RECORD_BYTES != 0)


def read_can_log(spark: SparkSession, path: str) -> DataFrame:
    """The log as rows; a misaligned or truncated file is an error. Splits fall on record boundaries, so a large log is
    read in parallel."""
    bad = misaligned_files(spark, path).limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['path']}: {bad[0]['length']} bytes is not a multiple of {RECORD_BYTES}")
    records = spark.createDataFrame(spark.sparkContext.binaryRecords(path, RECORD_BYTES).map(lambda b: (bytearray(b),)), "record binary")
    hexed = F.hex("record")

    def number(start: int, size: int):
        return F.conv(F.substring(hexed, start * 2 + 1, size * 2), 16, 10).cast("long")

    raw = number(4, 4)
    dlc = number(8, 1).cast("int")
    return records.select(
        number(0, 4).alias("timestamp_ms"), raw.bitwiseAND(F.lit(EXTENDED - 1)).alias("can_id"), dlc.alias("dlc"),
        F.lower(F.substring(hexed, F.lit(19), dlc * 2)).alias("data_hex"), (raw >= EXTENDED).alias("is_extended"),
    )


RECORD = np.dtype([("ms", ">u4"), ("id", ">u4"), ("dlc", "u1"), ("data", "V8")])
COLUMNS = "timestamp_ms bigint, can_id bigint, dlc int, data binary, is_extended boolean"


def _pack(batch: pa.RecordBatch) -> bytes:
    record = np.zeros(batch.num_rows, RECORD)
    record["ms"], record["dlc"] = batch.column("timestamp_ms").to_numpy(), batch.column("dlc").to_numpy()
    record["id"] = batch.column("can_id").to_numpy() | np.where(np.asarray(batch.column("is_extended")), EXTENDED, 0)
    record["data"] = np.frombuffer(b"".join(batch.column("data").to_pylist()), "V8")
    return record.tobytes()


@dataclass
class Written(WriterCommitMessage):
    name: str
    part: int
    records: int


class CanLogWriter(DataSourceArrowWriter):
    """A file per task under the job's own temporary folder; the commit moves the files of the tasks that count to their
    names. What a failed or repeated task has left goes with that folder, whether the job commits or aborts."""

    def __init__(self, uri: str, overwrite: bool):
        self.uri, self.overwrite, self.job = uri.rstrip("/"), overwrite, uuid.uuid4().hex

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.uri)

    def write(self, iterator):
        system, folder = self._place()
        name, records = f"{folder}/_temporary/{self.job}/{uuid.uuid4().hex}", 0
        system.create_dir(f"{folder}/_temporary/{self.job}", recursive=True)
        with system.open_output_stream(name) as out:
            for batch in iterator:
                out.write(_pack(batch))
                records += batch.num_rows
        return Written(name, TaskContext.get().partitionId(), records)

    def commit(self, messages):
        system, folder = self._place()
        before = [f.path for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.base_name.endswith(".bin")] if self.overwrite else []
        for m in messages:
            if m and m.records:
                system.move(m.name, f"{folder}/part-{m.part:05d}-{self.job}.bin")
        for path in before:
            system.delete_file(path)
        self._clean(system, folder)

    def abort(self, messages):
        self._clean(*self._place())

    def _clean(self, system, folder):
        if system.get_file_info(f"{folder}/_temporary/{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{folder}/_temporary/{self.job}")


class CanLogSource(DataSource):
    """`df.write.format("can_log").mode("append").save(uri)` for frames as `fixed_width` gives them. The URI is one that
    pyarrow opens: a mounted folder, hdfs, s3 or gs."""

    @classmethod
    def name(cls):
        return "can_log"

    def schema(self):
        return COLUMNS

    def writer(self, schema, overwrite):
        path = self.options["path"]
        return CanLogWriter(path if ":" in path else f"file://{path}", overwrite)


def fixed_width(frames: DataFrame) -> DataFrame:
    """Frames with their data as eight bytes, cut or filled with zeros."""
    data = F.unhex(F.rpad(F.substring("data_hex", 1, 16), 16, "0"))
    return frames.select(F.col("timestamp_ms").cast("bigint").alias("timestamp_ms"), F.col("can_id").cast("bigint").alias("can_id"), F.col("dlc").cast("int").alias("dlc"), data.alias("data"), "is_extended")


def write_can_log(frames: DataFrame, path: str, mode: str = "append") -> None:
    """Write the log: one file of whole records for each task that has rows, all of them or none. Frames: timestamp_ms, can_id,
    dlc, data_hex, is_extended, none of them null. A task that fails or runs twice leaves nothing behind; in mode `overwrite` the
    files of before go when the new ones are there."""
    frames.sparkSession.dataSource.register(CanLogSource)
    fixed_width(frames).write.format("can_log").mode(mode).save(path)
