"""State machines that are called for shares of all keys: as many calls and rows of state for any number of keys."""

import random

from pyspark.sql import functions as F
from test_streams import arrow_batches

from roadlake.operators.validate import validate
from roadlake.streaming import carry, dimension, rates, sessions
from roadlake.streaming.run import large_state, replayed, work_dir
from roadlake.streaming.shares import SHARES, packed, unpack


def run(spark, stream):
    """The table that a stream wrote, and the most rows of state it held."""
    folder = work_dir(spark)
    with large_state(spark):
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()
        query.awaitTermination()
    held = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    return spark.read.schema(stream.schema).parquet(f"{folder}/out"), held


def test_rows_are_packed_by_share_and_keep_their_order(spark):
    rows = spark.range(0, 1000, 1, 2).select(F.concat(F.lit("s"), F.col("id") % 40).alias("session"), "id", (F.col("id") * 3).alias("arrived_us")).withColumn("session", F.when(F.col("id") % 40 != 7, F.col("session")))
    with arrow_batches(spark, 30):
        got, alone = packed(rows, ["session"], 5, rows_at_once=90).collect(), packed(rows, ["session"], None, rows_at_once=90).collect()
    assert len(got) > 10 and {r.share for r in got} <= set(range(5))
    sessions = {}
    for r in got:
        table = unpack([r.payload]).to_pydict()
        assert r.arrived_us == max(table["arrived_us"])
        for session, number in zip(table["session"], table["id"]):
            sessions.setdefault(session, []).append((r.share, number))
    assert sorted(n for v in sessions.values() for _, n in v) == list(range(1000)) and None in sessions
    assert all(len({share for share, _ in v}) == 1 for v in sessions.values())
    home = {n: None if n % 40 == 7 else f"s{n % 40}" for n in range(1000)}
    numbers = [(r.session, n) for r in alone for n in unpack([r.payload])["id"].to_pylist()]
    assert len(numbers) == 1000 and all(home[n] == session for session, n in numbers)


def test_rate_check_of_many_signals(spark):
    """1,500 signals, values that arrive up to a hundred seconds late and in any order, in batches that cut through them."""
    dice = random.Random(3)
    rows = [(f"s{k % 750}", "ab"[k % 2], n, dice.randrange(10) * 20_000_000 + dice.randrange(3), dice.uniform(0, 20)) for n, k in enumerate(k for k in range(1500) for _ in range(5))]
    samples = spark.createDataFrame([(*r, r[3] + dice.randrange(100_000_000)) for r in rows], "session string, signal string, seq long, t_us long, value double, arrived_us long")
    last = spark.createDataFrame([(None, None, None, 900_000_000, None, 900_000_000)], samples.schema)
    out, held = run(spark, rates.rate_check_stream(replayed(samples.unionByName(last), "arrived_us", 6, 2), {"a": (1.0, 19.0)}, {"a": 5.0, "b": 7.0}, 100_000_000))
    want = validate(samples, {"a": (1.0, 19.0)}, {"a": 5.0, "b": 7.0}, order=("t_us", "seq"))
    columns = ["session", "signal", "seq", "t_us", "value", "reason"]
    assert {tuple(r) for r in out.select(columns).collect()} == {tuple(r) for r in want.select(columns).collect()}
    assert out.count() == len(rows) and held <= 2 * SHARES


def carried(frames, batches, interval, length):
    """The rows of `carry_stream`, a frame and a sample at a time: {(session, start): (signals, carried, late)}."""
    least, most = min(f[3] for f in frames), max(f[3] for f in frames)
    step, state, out = (most - least) // batches + 1, {}, {}
    for part in range(batches):
        now = [f for f in frames if (f[3] - least) // step == part]
        for session in sorted({f[0] for f in now}):
            held, reached = state.get(session, ({}, None))
            mine, own = [f for f in now if f[0] == session], {}
            for _, _, base, _, times, signals, values in mine:
                for t, signal, value in zip(times, signals, values):
                    if t - base < length and value is not None:
                        samples = own.setdefault(base + max(0, (t - base) // interval) * interval, {})
                        if signal not in samples or t >= samples[signal][1]:
                            samples[signal] = (value, t)
            for start in sorted({f[2] + k for f in mine for k in range(0, length, interval)}):
                late = reached is not None and start <= reached
                for signal, (value, t) in own.get(start, {}).items():
                    if signal not in held or t >= held[signal][1]:
                        held[signal] = (value, t)
                shown = own.get(start, {}) if late else held
                out.setdefault((session, start), []).append(({k: v for k, (v, _) in shown.items()}, {k: (start + interval - t) // 1000 for k, (_, t) in shown.items() if t < start}, late))
                reached = start if reached is None else max(reached, start)
            state[session] = (held, reached)
    return out


def test_carry_of_many_sessions(spark):
    """1,200 sessions, frames without samples, that are late, that come twice, and samples of the frame before or after."""
    dice, frames = random.Random(5), []
    for k in range(1200):
        for base in dice.sample(range(0, 40_000_000, 2_000_000), 6):
            times = sorted(base + dice.randrange(-200_000, 2_100_000) for _ in range(dice.randrange(6)))
            frames.append((f"s{k}", f"d{k % 3}", base, base + dice.randrange(9_000_000), times, [dice.choice("abcde") for _ in times], [dice.choice([None, *range(50)]) for _ in times]))
    frames = [(*f[:6], [None if v is None else float(v) for v in f[6]]) for f in frames]
    ddl = "session string, device string, base_us long, arrived_us long, times array<long>, signals array<string>, samples array<double>"
    with arrow_batches(spark, 500):
        out, state = run(spark, carry.carry_stream(replayed(spark.createDataFrame(frames, ddl), "arrived_us", 4, 2), 1_000_000, 2_000_000, delay="1 day"))
    got = {}
    for r in out.collect():
        got.setdefault((r.session, r.start_us), []).append((r.signals, r.carried, r.late))
        assert set(r.seen) == set(r.signals)
    assert got == carried(frames, 4, 1_000_000, 2_000_000) and any(late for rows in got.values() for _, _, late in rows)
    assert state <= 3 * SHARES


def test_a_session_of_many_signals_is_cut(spark):
    """Three hundred signals and a thousand intervals, more values than a result row has, go on from a table and are forgotten in time."""
    names = [f"n{k:03}" for k in range(300)]
    frames = [("s", "d", t * 1_000_000, t * 1_000_000, [t * 1_000_000] * (300 if t == 0 else 1), names if t == 0 else [names[t % 300]], [float(t)] * (300 if t == 0 else 1)) for t in range(1000)]
    ddl = "session string, device string, base_us long, arrived_us long, times array<long>, signals array<string>, samples array<double>"
    out, _ = run(spark, carry.carry_stream(replayed(spark.createDataFrame(frames, ddl), "arrived_us", 2)))
    rows = {r.base_us // 1_000_000: r for r in out.collect()}
    assert sorted(rows) == list(range(1000)) and all(len(r.signals) == 300 for r in rows.values())
    assert all(rows[t].signals[names[k]] == (t - (t - k) % 300 if t >= k else 0) for t in range(0, 1000, 37) for k in range(300))
    tail = [("s", "d", 1000_000_000, 1000_000_000, [], [], []), ("x", "d", 0, 1_100_000_000, [], [], []), ("x", "d", 0, 2_000_000_000, [], [], []), ("s", "d", 2000_000_000, 2_600_000_000, [], [], [])]
    again, _ = run(spark, carry.carry_stream(replayed(spark.createDataFrame(tail, ddl), "arrived_us", 4), written=out, forget_ms=60_000))
    assert {r.base_us // 1_000_000: len(r.signals) for r in again.collect() if r.session == "s"} == {1000: 300, 2000: 0}


def test_close_of_many_sessions(spark):
    """2,000 sessions with silences of both lengths, ends in their midst and records of equal time; some come an hour late."""
    dice, rows = random.Random(7), []
    for k in range(2000):
        t, late = dice.randrange(5_000), dice.choice([0, 3600])
        for _ in range(dice.randrange(1, 14)):
            t += dice.choice([0, 1, 60, 119, 120, 121, 600, 1799, 1800, 2000])
            rows.append((f"s{k}", f"d{k % 3}", t * 1_000_000, len(rows), dice.choice(["can", "can", "gps", "session_end"]), (t + late) * 1_000_000))
    ddl = "session string, device string, t_us long, seq long, kind string, arrived_us long"
    records = spark.createDataFrame(rows, ddl)
    tick = spark.createDataFrame([("clock", "clock", 0, 0, sessions.TICK, 60_000_000_000)], ddl)
    with arrow_batches(spark, 1000):
        out, held = run(spark, sessions.close_stream(replayed(records.unionByName(tick), "arrived_us", 6, 2)))
    columns = ["session", "device", "first_us", "last_us", "can_frames", "records", "ended", "late"]
    want = {tuple(r) for r in sessions.close_batch(records, ["t_us", "seq"]).select(columns).collect()}
    assert {tuple(r) for r in sessions.totals(out).select(columns).collect()} == want and len(want) == 2000
    assert any(r[-1] for r in want) and out.where("first_us IS NOT NULL").count() == 2000 and held <= SHARES


def test_wait_of_many_frames_and_versions(spark):
    """12 sessions of 1,500 frames at odd times over four days, repeated and empty ones among them, and 60 versions of the session's row."""
    dice, rows, want = random.Random(11), [], []
    for k in range(12):
        versions = sorted(dice.randrange(3_000_000_000) // 1_000_000 * 1_000_000 for _ in range(60 if k else 0))
        named = {came: (dice.choice([None, n]), f"u{n}") for n, came in enumerate(versions)}
        rows += [(f"s{k}", "d", "dimension", came, None, None, *named[came]) for came in named]
        bases = [dice.randrange(4 * 86_400_000_000) for _ in range(1300)]
        frames = [(dice.randrange(3_000_000_000), base, dice.choice(["complete", "incomplete", "empty"])) for base in bases + dice.sample(bases, 200)]
        rows += [(f"s{k}", "d", "frame", at, base, status, None, None) for at, base, status in frames]
        held = set()
        for at, base, status in sorted(frames):
            outcome = "replayed" if base in held else "empty" if status == "empty" else "known" if versions and versions[0] <= at + 30_000_000 else "unknown"
            if outcome in ("known", "unknown"):
                held.add(base)
            in_force = named[max(v for v in versions if v <= max(at, versions[0]))] if outcome == "known" else (None, None)
            want.append((f"s{k}", base, status, outcome, *in_force))
    rows.append(("clock", "d", "tick", 4_000_000_000, None, None, None, None))
    ddl = "session string, device string, kind string, arrived_us long, base_us long, status string, vehicle_id long, user_sub string"
    with arrow_batches(spark, 700):
        out, state = run(spark, dimension.wait_for_dimension(replayed(spark.createDataFrame(rows, ddl), "arrived_us", 5, 2)))
    got = [tuple(r) for r in out.select("session", "base_us", "status", "outcome", "vehicle_id", "user_sub").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[3] for r in got} == {"known", "unknown", "empty", "replayed"} and state <= 13 * 8  # not a row for each frame
