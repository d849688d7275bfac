"""Keyed streams: rows of a key over several Arrow batches, late and repeated rows, restarts from the written table."""

import random
from contextlib import contextmanager

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from roadlake.operators import sessions as S
from roadlake.plans import decoding, drives
from roadlake.sources import upsert
from roadlake.streaming import carry, decode, dimension, rates, rollup, sessions
from roadlake.streaming.run import large_state, replayed, run_to_table, work_dir

SF = "/root/testdata/sf0.001"


@contextmanager
def arrow_batches(spark, rows):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("name", ["st4_frame_assembly", "st5_dimension_wait", "st6_session_close_stream", "st_a8_rollup"])
def test_small_arrow_batches(spark, name):
    with arrow_batches(spark, 50):
        assert compare(spark, duck(SF), SF, name, queries()[name], oracle_sql()[name])[2] is None


def test_a_session_without_a_gap_stays_open(spark):
    """Four hours of a record a second, dealt to the stream in hours that are not in order."""
    rows = [("s", "d", t * 1_000_000, t, "can", 14_400_000_000) for t in range(14_400)]
    random.Random(1).shuffle(rows)
    rows.append(("clock", "clock", 0, 0, sessions.TICK, 20_000_000_000))
    records = spark.createDataFrame(rows, "session string, device string, t_us long, seq long, kind string, arrived_us long")
    with arrow_batches(spark, 1000):
        out = sessions.totals(run_to_table(sessions.close_stream(replayed(records, "arrived_us", 2)))).collect()
    assert [(r.session, r.first_us, r.last_us, r.can_frames, r.records, r.ended, r.late) for r in out] == [("s", 0, 14_399_000_000, 14_400, 14_400, False, 0)]


WAITING = "session string, device string, kind string, arrived_us long, base_us long, status string, vehicle_id long, user_sub string"


def test_frames_wait_in_order_and_are_written_once(spark):
    second = 1_000_000
    rows = [("s", "d", "frame", (100 + k) * second, k * second, "complete", None, None) for k in range(5)]
    rows += [("s", "d", "frame", 150 * second, 2 * second, "complete", None, None)]  # replayed
    rows += [("s", "d", "dimension", 132 * second, None, None, 7, "a"), ("s", "d", "dimension", 160 * second, None, None, 8, None), ("s", "d", "frame", 161 * second, 9 * second + 1, "incomplete", None, None)]
    rows += [("never", "d", "frame", 100 * second, 0, "complete", None, None), ("clock", "d", "tick", 500 * second, None, None, None, None)]
    records = spark.createDataFrame(rows, WAITING)
    out = {(r.session, r.base_us, r.outcome): (r.vehicle_id, r.user_sub) for r in run_to_table(dimension.wait_for_dimension(replayed(records, "arrived_us"))).collect()}
    # the first two had waited longer than half a minute when the row came
    assert out == {("s", 0, "unknown"): (None, None), ("s", second, "unknown"): (None, None), **{("s", k * second, "known"): (7, "a") for k in (2, 3, 4)}, ("s", 2 * second, "replayed"): (None, None),
                   ("s", 9 * second + 1, "known"): (8, None), ("never", 0, "unknown"): (None, None)}
    written = spark.createDataFrame([("s", "d", k * second) for k in range(5)] + [("other", "d", 0)], "session string, device string, base_us long")
    again = run_to_table(dimension.wait_for_dimension(replayed(records, "arrived_us"), written=written)).groupBy("session", "outcome").count().collect()
    assert {(r.session, r.outcome): r["count"] for r in again} == {("s", "replayed"): 6, ("s", "known"): 1, ("never", "unknown"): 1}


def test_carry_over_a_restart_and_late_frames(spark):
    frames = [("s", "d", 0, 1, [10, 20], ["a", "b"], [1.0, 2.0]), ("s", "d", 1_000_000, 2, [1_000_010], ["a"], [3.0]), ("s", "d", 2_000_000, 3, [], [], [])]
    ddl = "session string, device string, base_us long, arrived_us long, times array<long>, signals array<string>, samples array<double>"
    first = run_to_table(carry.carry_stream(replayed(spark.createDataFrame(frames[:2], ddl), "arrived_us", 2), 500_000))
    assert {(r.start_us, tuple(sorted(r.signals.items())), tuple(sorted(r.carried.items())), r.late) for r in first.collect()} == {
        (0, (("a", 1.0), ("b", 2.0)), (), False), (500_000, (("a", 1.0), ("b", 2.0)), (("a", 999), ("b", 999)), False),
        (1_000_000, (("a", 3.0), ("b", 2.0)), (("b", 1499),), False), (1_500_000, (("a", 3.0), ("b", 2.0)), (("a", 999), ("b", 1999)), False)}
    late = ("s", "d", 500_000, 4, [500_001], ["c"], [9.0])
    second = run_to_table(carry.carry_stream(replayed(spark.createDataFrame([frames[2], late], ddl), "arrived_us", 1), 500_000, written=first)).collect()
    got = {(r.start_us, r.late): (dict(r.signals), dict(r.carried)) for r in second}
    assert got[(500_000, True)] == ({"c": 9.0}, {}) and got[(1_000_000, True)] == ({}, {})
    assert got[(2_000_000, False)] == ({"a": 3.0, "b": 2.0, "c": 9.0}, {"a": 1499, "b": 2499, "c": 1999})


def test_rate_check_reports_late_values(spark):
    rows = [("s", "v", k, k * 1000, v, a) for k, (v, a) in enumerate([(1.0, 3000), (2.0, 1100), (50.0, 2000), (3.0, 9000), (4.0, 4100)])]
    rows += [("s", "free", 9, 0, 5.0, 9_000), ("s", "v", 10, 0, None, 10), (None, None, None, 50_000, None, 50_000)]
    samples = spark.createDataFrame(rows, "session string, signal string, seq long, t_us long, value double, arrived_us long")
    out = run_to_table(rates.rate_check_stream(replayed(samples, "arrived_us"), {}, {"v": 10.0}, 5000))
    assert {(r.seq, r.reason) for r in out.collect()} == {(0, None), (1, None), (2, "RATE_IMPLAUSIBLE"), (3, rates.LATE), (4, None), (9, None), (10, None)}


def test_roll_up_of_redelivered_messages(spark):
    """The same messages delivered twice leave the session as it is, but for the count of duplicates; so does an upsert run again."""
    records = drives.session_records(spark, SF).where("session = 'c1' OR session = 'c2'").withColumn("arrival", F.col("arrival") + 1_700_000_000_000_000)
    last = records.agg(F.max("arrival")).first()[0]
    twice = records.unionByName(records.withColumn("arrival", F.col("arrival") + last % 1_000_000_000))
    folder = work_dir(spark)
    with large_state(spark):
        for _ in range(1):
            writer = upsert.upsert_stream(rollup.roll_up_stream(replayed(twice, "arrival")), f"{folder}/out", f"{folder}/log", S.KEYS, ["version"], "device", guard="version")
            writer.outputMode("update").trigger(availableNow=True).start().awaitTermination()
    table = spark.read.parquet(f"{folder}/out")
    columns = [*S.KEYS, "user_sub", *S.START_FIELDS, *S.END_FIELDS, "frames_received", "last_frame_received_us"]
    want = {tuple(r) for r in S.roll_up(records).select(*columns).collect()}
    before = {tuple(r) for r in table.select(*columns).collect()}
    assert before == want and table.agg(F.sum("duplicates")).first()[0] == S.roll_up(twice).agg(F.sum("duplicates")).first()[0]
    upsert.upsert_parquet(f"{folder}/out", spark.read.parquet(f"{folder}/out"), S.KEYS, ["version"], "device", guard="version")
    assert {tuple(r) for r in spark.read.parquet(f"{folder}/out").select(*columns).collect()} == before


def test_decode_reads_dimensions_for_every_micro_batch(spark):
    """A session that is registered between two micro-batches is decoded from the second on; a batch run again replaces itself."""
    folder = work_dir(spark)
    tables = {"sessions": ("session string, device string, vehicle_id long", []), "vehicles": ("vehicle_id long, dbc_id long", [(1, 1)]), "dbcs": ("dbc_id long, name string, parses boolean", [(1, "alpha", True)])}
    for name, (ddl, rows) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/{name}")
    read = [(lambda session, n=n: session.read.schema(tables[n][0]).parquet(f"{folder}/{n}")) for n in tables]
    dimensions = decode.Dimensions(*read, lambda session: session.createDataFrame(decoding.DBC_ROWS, decoding._DBC_SCHEMA))
    frames = spark.createDataFrame([("s", "d", 513, "0001000200030004")], "session string, device string, can_id long, data_hex string")
    decode.write_decoded(frames, 0, dimensions, folder)
    spark.createDataFrame([("s", "d", 1)], tables["sessions"][0]).write.mode("append").parquet(f"{folder}/sessions")
    for _ in range(2):
        decode.write_decoded(frames, 1, dimensions, folder)
    got = {(r.batch, r.outcome, r.reason) for r in spark.read.parquet(f"{folder}/outcomes").collect()}
    assert got == {(0, "dropped", "session not found"), (1, "decoded", None)}
    assert {(r.batch, r.signal, r.value) for r in spark.read.parquet(f"{folder}/signals").collect()} == {(1, "Part", 1.0), (1, "PartSwapped", 118.0)}
