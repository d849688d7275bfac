"""The chunked primitives against plain windows and a sequential fold, with chunks that split every key."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlake.operators.ordered import (
    chunked_fold, first_known, last_known, next_, number_runs, prev, running_max, running_min, running_sum, scan,
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    # one key holds most of the rows; times repeat and leave whole chunks empty
    data = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(4)}", rng.choice([rng.randrange(300), rng.randrange(5000, 5200)]), i,
             rng.randrange(50) if rng.random() < 0.6 else None) for i in range(600)]
    return spark.createDataFrame(data, "k string, t long, i long, v long").cache()


@pytest.mark.parametrize("chunk", [1, 7, 100, 10**9])
def test_scan_equals_window(rows, chunk):
    w = Window.partitionBy("k").orderBy("t", "i")
    up, down = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    ahead = w.rowsBetween(1, Window.unboundedFollowing)
    v = F.col("v")
    got = scan(rows, ["k"], ["t", "i"], {
        "p": prev(v), "n": next_(v), "l": last_known(v), "lx": last_known(v, inclusive=False), "fx": first_known(v, inclusive=False),
        "s": running_sum(v), "sx": running_sum(v, inclusive=False), "hi": running_max(v), "lo": running_min(v)}, chunk)
    want = rows.select("*", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"), F.last("v", True).over(up).alias("l"), F.last("v", True).over(down).alias("lx"),
                       F.first("v", True).over(ahead).alias("fx"), F.sum("v").over(up).alias("s"), F.sum("v").over(down).alias("sx"), F.max("v").over(up).alias("hi"), F.min("v").over(up).alias("lo"))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == sorted(map(tuple, want.collect()), key=lambda r: r[2])


@pytest.mark.parametrize("chunk", [1, 13, 10**9])
def test_runs_equal_window(rows, chunk):
    w = Window.partitionBy("k").orderBy("t", "i")
    got = number_runs(rows, ["k"], ["t", "i"], F.col("t"), lambda p, c: c - p > 20, "run", chunk)
    starts = F.coalesce((F.col("t") - F.lag("t").over(w)) > 20, F.lit(True)).cast("long")
    want = rows.withColumn("st", starts).select("i", F.sum("st").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    assert dict(got.select("i", "run").collect()) == dict(want.collect())


@pytest.mark.parametrize("chunk", [1, 9, 10**9])
def test_fold_equals_loop(rows, chunk):
    def step(piece, state):
        held, out = (None if state is None else state["h"]), []
        for v in piece["v"].tolist():
            ok = held is None or abs(v - held) <= 8
            held = v if ok else held
            out.append(ok)
        return out, {"h": held}

    known = rows.where("v IS NOT NULL")
    got = {r["i"]: r["ok"] for r in chunked_fold(known, ["k"], ["t", "i"], ["v"], step, "ok", "boolean", chunk).collect()}
    want, held = {}, {}
    for r in sorted(known.collect(), key=lambda r: (r["k"], r["t"], r["i"])):
        h = held.get(r["k"])
        want[r["i"]] = h is None or abs(r["v"] - h) <= 8
        held[r["k"]] = r["v"] if want[r["i"]] else h
    assert got == want


def test_a_latched_value_takes_three_rounds_and_one_read(spark, monkeypatch):
    """Two hundred chunks that all depend on the first: nothing is ever near the first value again."""
    from roadlake.operators import ordered

    rounds, read = [], spark.sparkContext.accumulator(0)
    monkeypatch.setattr(ordered, "spread", lambda df, *keys, f=ordered.spread: rounds.append(keys) or f(df, *keys))

    def seen(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    rows = spark.range(2000).select(F.lit("a").alias("k"), F.col("id").alias("t"), F.col("id").alias("i"), F.when(F.col("id") == 0, 1e6).otherwise(F.col("id").cast("double")).alias("v")).mapInPandas(seen, "k string, t long, i long, v double")

    def step(piece, state):
        held, out = (None if state is None else state["h"]), []
        for v in piece["v"].tolist():
            ok = held is None or abs(v - held) <= 8
            held = v if ok else held
            out.append(ok)
        return out, {"h": held}

    got = chunked_fold(rows, ["k"], ["t", "i"], ["v"], step, "ok", "boolean", 10).where("ok").collect()
    assert [r["i"] for r in got] == [0]
    assert read.value == 2000 and len([k for k in rounds if ordered.RUN in k]) <= 2
