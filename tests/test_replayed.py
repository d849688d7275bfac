"""Recorded tables as streams."""

import pytest

from roadlake.streaming import run


@pytest.mark.parametrize("files", [1, 3])
def test_a_micro_batch_is_a_part_however_few_rows_it_has(spark, tmp_path, files):
    """Parts of many rows, of one and of none, in more files than some have rows."""
    times = [*range(40), 45, 70, 71, *range(80, 120)]
    stream = run.replayed(spark.createDataFrame([(t,) for t in times], "t long").coalesce(1), "t", 6, files)
    seen = []
    writer = stream.writeStream.foreachBatch(lambda rows, _: seen.append(sorted(r.t for r in rows.collect()))).option("checkpointLocation", str(tmp_path))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert seen == [[t for t in times if t // 20 == k] for k in range(6)]


def test_parts_are_written_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(run, "ROWS_PER_FILE", 100, raising=False)
    stream = run.replayed(spark.range(0, 6000, 1, 3).withColumnRenamed("id", "t"), "t")
    folder = stream._jdf.queryExecution().analyzed().toString().split("FileSource[")[1].split("]")[0]
    assert len(spark.read.parquet(folder).inputFiles()) >= 6 * 10
