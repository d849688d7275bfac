"""The CAN log data source: whole files of the tasks that count, and nothing else."""

import pytest
from pyspark.sql import functions as F

from roadlake.sources import can_log


def frames(spark, n, first=0):
    rows = [(first + i, i % 2000, i % 9, "00112233445566ff"[: i % 9 * 2], i % 3 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "timestamp_ms long, can_id long, dlc int, data_hex string, is_extended boolean").repartition(3)


def there(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def test_round_trip_append_and_overwrite(spark, tmp_path):
    folder = tmp_path / "log"
    can_log.write_can_log(frames(spark, 100), str(folder))
    can_log.write_can_log(frames(spark, 40, 1000), f"file://{folder}")
    back = can_log.read_can_log(spark, f"{folder}/*.bin")
    assert {tuple(r) for r in back.select("timestamp_ms", "can_id", "dlc", "data_hex", "is_extended").collect()} == {tuple(r) for r in frames(spark, 100).union(frames(spark, 40, 1000)).collect()}
    assert len(there(folder)) == 6 and can_log.misaligned_files(spark, f"{folder}/*.bin").isEmpty()
    can_log.write_can_log(frames(spark, 7), str(folder), "overwrite")
    assert can_log.read_can_log(spark, f"{folder}/*.bin").count() == 7


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    folder = tmp_path / "log"
    can_log.write_can_log(frames(spark, 10), str(folder))
    before = there(folder)
    broken = frames(spark, 100).withColumn("can_id", F.when(F.col("timestamp_ms") == 57, F.raise_error(F.lit("broken"))).otherwise(F.col("can_id")))
    with pytest.raises(Exception, match="broken"):
        can_log.write_can_log(broken, str(folder))
    assert there(folder) == before
