"""Times the headline queries and three stage rates; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


from roadlake.plans import catalog, decoding, drives, driving, views  # noqa: E402
from roadlake.operators import decode, state, tracks  # noqa: E402
from roadlake.session import build_session  # noqa: E402

HEADLINE = [
    "a5_average_speed", "a1_window_stats", "c4_profile_decode", "c1_dbc_decode", "v3_rate_check", "a6_interval_stats", "w1_carry_forward",
    "j2_frame_completeness", "d7_track_position", "w2_lap_split", "w12_delta_trace", "w8_drive_totals", "j7_asof_interpolate", "a8_session_rollup",
    "a12_lag_quantiles", "a10_id_inventory", "d4_connected_ways", "st2_geofence_laps", "st1_speed_stream",
]
MESSAGES_PER_CAR = 700  # the yardstick: messages a second that one device sends


def timed(run) -> float:
    start = time.time()
    run()
    return time.time() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    def query(name):
        drain(catalog.QUERIES[name](spark, sf))

    query("a5_average_speed")
    times = {}
    for name in HEADLINE:
        times[name] = round(timed(lambda: query(name)), 3)
        print(f"{name} {times[name]}", file=sys.stderr)

    signals = spark.createDataFrame(decoding.DBC_ROWS, decoding._DBC_SCHEMA)
    frames = decoding.resolved(spark, sf).where("data_hex <> 'zz'")
    stages = {
        "decode": (views.table(spark, sf, "lineitem").count(), lambda: drain(decode.decode(frames, signals))),
        "interval_snapshot": (views.table(spark, sf, "events").count(), lambda: drain(state.signal_intervals(state.place(drives.can_samples(spark, sf), drives.SIX // 2, drives.SIX)))),
        "track_match": (views.table(spark, sf, "events").count(), lambda: drain(tracks.track_positions(views.v_gps(spark, sf), driving.loop(spark)))),
    }
    rates = {}
    for name, (rows, run) in stages.items():
        run()
        per_second = rows / min(timed(run) for _ in range(2))
        rates[name] = {"rows_per_s": round(per_second), "cars_in_real_time": round(per_second / MESSAGES_PER_CAR, 1)}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf).name,
        "cores": int(cpus), "spark": spark.version, "stages": rates,
    }))


if __name__ == "__main__":
    main()
