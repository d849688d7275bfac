"""Streaming frame assembly: a session's frames close in order, each when its counts match its receipt or can no longer grow."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roadlake.operators.state import SAMPLE_KINDS

# A short topic is given up after 30 s of other traffic, or 10 s of none.
LAG_MS = 30_000
IDLE_MS = 10_000
FORGET_MS = 24 * 3_600_000

KINDS = (*SAMPLE_KINDS, "session")
SENT = ("sent_gps", "sent_imu", "sent_can")
COUNTS = [*(f"n_{k}" for k in KINDS), *SENT, "opened_ms"]
OUTPUT = "session string, device string, base_us bigint, status string, n_gps bigint, n_imu bigint, n_can bigint, n_unknown bigint, n_discovery bigint"


class FrameAssembly(StatefulProcessor):
    """State of one session and device: its open frames, how far each topic has come, and what has been closed.

    Timers run on the clock of arrival. A device that uploads an old drive late is late for nobody: only its own closed
    frames decide what is late, and late samples are reported as rows of status `late`."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "base_us bigint", ", ".join(f"{c} bigint" for c in COUNTS))
        self.reached = handle.getValueState("reached", ", ".join(f"{k} bigint" for k in KINDS) + ", closed_us bigint, arrived_ms bigint")

    def _load(self):
        frames = {k[0]: dict(zip(COUNTS, v)) for k, v in self.open.iterator()}
        reached = dict(zip([*KINDS, "closed_us", "arrived_ms"], self.reached.get())) if self.reached.exists() else dict.fromkeys([*KINDS, "closed_us", "arrived_ms"], -1)
        return frames, reached

    def handleInputRows(self, key, rows, timerValues):
        frames, reached = self._load()
        late: dict[int, dict[str, int]] = {}
        sent: dict[int, tuple] = {}  # a frame's latest receipt; rows may come as several frames in no order of arrival
        for pdf in rows:
            known = pdf[pdf["kind"].isin(KINDS)]
            arrived = known.groupby("base_us")["arrived_us"].min() // 1000
            for (base, kind), n in known.groupby(["base_us", "kind"]).size().items():
                if base <= reached["closed_us"]:
                    counts = late.setdefault(int(base), {})
                    counts[f"n_{kind}"] = counts.get(f"n_{kind}", 0) + int(n)
                    continue
                frame = frames.setdefault(int(base), dict.fromkeys(COUNTS, 0) | {"opened_ms": int(arrived[base])})
                frame[f"n_{kind}"] += int(n)
                frame["opened_ms"] = min(frame["opened_ms"], int(arrived[base]))
                reached[kind] = max(reached[kind], int(base))
            receipts = known[(known["kind"] == "session") & (known["base_us"] > reached["closed_us"])]
            for base, *receipt in receipts[["base_us", "arrived_us", *SENT]].itertuples(index=False):
                sent[int(base)] = max(sent.get(int(base), (-1,)), tuple(map(int, receipt)))
            if len(known):
                reached["arrived_ms"] = max(reached["arrived_ms"], int(known["arrived_us"].max()) // 1000)
        for base, (_, *counts) in sent.items():
            frames[base].update(zip(SENT, counts))
        out = [self._row(key, base, "late", counts) for base, counts in sorted(late.items())]
        yield from self._close(key, frames, reached, None, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        frames, reached = self._load()
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        if not frames and now >= reached["arrived_ms"] + FORGET_MS:
            self.reached.clear()
            return
        yield from self._close(key, frames, reached, now, [])

    def _row(self, key, base, status, counts):
        return {"session": key[0], "device": key[1], "base_us": base, "status": status, **{f"n_{k}": counts.get(f"n_{k}", 0) for k in SAMPLE_KINDS}}

    def _status(self, base, c, reached, now):
        """The frame's final status, or None while it may still grow."""
        given_up = now is not None and (now >= c["opened_ms"] + LAG_MS or now >= reached["arrived_ms"] + IDLE_MS)
        some = "incomplete" if any(c[f"n_{k}"] for k in SAMPLE_KINDS) else "empty"
        if c["n_session"]:
            short = [k for k in ("gps", "imu") if c[f"n_{k}"] != c[f"sent_{k}"]]
            if c["n_can"] + c["n_unknown"] + c["n_discovery"] != c["sent_can"]:
                short += ["can", "unknown", "discovery"]
            if not short:
                return "complete"
        else:
            short = list(KINDS)
        return some if given_up or all(reached[k] > base for k in short) else None

    def _close(self, key, frames, reached, now, out):
        for base in sorted(frames):
            status = self._status(base, frames[base], reached, now)
            if status is None:
                break
            out.append(self._row(key, base, status, frames.pop(base)))
            reached["closed_us"] = max(reached["closed_us"], base)
        held = {k[0] for k, _ in self.open.iterator()}
        for base in held - frames.keys():
            self.open.removeKey((base,))
        for base, c in frames.items():
            self.open.updateValue((base,), tuple(c[n] for n in COUNTS))
        self.reached.update(tuple(reached.values()))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if frames:
            oldest = min(frames)
            due = min(frames[oldest]["opened_ms"] + LAG_MS, reached["arrived_ms"] + IDLE_MS)
            self.handle.registerTimer(due if now is None else max(due, now + 1))
        else:
            self.handle.registerTimer(reached["arrived_ms"] + FORGET_MS)
        if out:
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def assemble(records: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """`records`: session, device, base_us, arrived_us, kind, sent_gps, sent_imu, sent_can (set on receipts, kind
    "session"). The watermark is on arrival, so it drops nothing that comes within `delay` of its turn, however old the
    frame. A record of another kind only moves the clock."""
    timed = records.withColumn("arrival", F.timestamp_micros("arrived_us")).withWatermark("arrival", delay)
    return timed.groupBy("session", "device").transformWithStateInPandas(FrameAssembly(), OUTPUT, "append", "eventTime")


def assemble_windowed(records: DataFrame) -> DataFrame:
    """The same counts without custom state, for devices that upload in time: counts per frame, combined before the
    shuffle, emitted once event time has passed the frame by the lag. Older samples are dropped by the watermark."""
    timed = records.withColumn("event_time", F.timestamp_micros("base_us")).withWatermark("event_time", f"{LAG_MS // 1000} seconds")
    counted = timed.groupBy("session", "device", "base_us", F.window("event_time", "1 second")).agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS], *[F.max(c).alias(c) for c in SENT]
    )
    whole = (F.col("n_session") > 0) & (F.col("n_gps") == F.col("sent_gps")) & (F.col("n_imu") == F.col("sent_imu")) & (
        F.col("n_can") + F.col("n_unknown") + F.col("n_discovery") == F.col("sent_can")
    )
    some = sum((F.col(f"n_{k}") for k in SAMPLE_KINDS), F.lit(0)) > 0
    status = F.when(whole, "complete").when(some, "incomplete").otherwise("empty")
    return counted.select("session", "device", "base_us", status.alias("status"), *[f"n_{k}" for k in SAMPLE_KINDS])
