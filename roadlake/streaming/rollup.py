"""Session rows on a stream: the roll-up of a session's messages, given out whole whenever it changes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roadlake.operators.sessions import END_FIELDS, KEYS, START_FIELDS
from roadlake.streaming.timers import FORGET_MS, SeenSeconds, only_timer

TYPES = {"mode": "string", "vehicle_id": "bigint", "track_id": "bigint", "started_us": "bigint", "ended_us": "bigint", "end_reason": "string",
         "frames_expected": "bigint", "first_frame_us": "bigint", "last_frame_us": "bigint"}
_PART = {name: ", ".join(f"{c} {TYPES[c]}" for c in fields) for name, fields in (("session_start", START_FIELDS), ("session_end", END_FIELDS))}
OUTPUT = (f"session string, device string, user_sub string, {_PART['session_start']}, {_PART['session_end']}, frames_received bigint, duplicates bigint, "
          "last_frame_received_us bigint, version bigint")


class SessionRollUp(StatefulProcessor):
    """State of a session: its latest start, end and user with the place in the order of arrival that each had, counts, and a
    bitmap of the seconds that have had a frame in place of a row for each.

    Results do not depend on how records are dealt over frames and micro-batches, so long as arrival grows from batch to
    batch: of repeated frames the first to arrive counts, of starts, ends and users the last."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.start = handle.getValueState("start", f"arrival bigint, {_PART['session_start']}")
        self.end = handle.getValueState("end", f"arrival bigint, {_PART['session_end']}")
        self.user = handle.getValueState("user", "arrival bigint, user_sub string")
        self.counts = handle.getValueState("counts", "frames bigint, duplicates bigint, received_us bigint, version bigint")
        self.seconds = handle.getMapState("seconds", *SeenSeconds.STATE)

    def handleInputRows(self, key, rows, timerValues):
        frames, duplicates, last, version = self.counts.get() if self.counts.exists() else (0, 0, None, 0)
        seen, fresh, newest = SeenSeconds(self.seconds), {}, 0
        for pdf in rows:
            version, newest = version + len(pdf), max(newest, int(pdf["arrival"].max()))
            for kind, state, fields in (("session_start", self.start, START_FIELDS), ("session_end", self.end, END_FIELDS)):
                self._latest(state, pdf[pdf["message_type"] == kind], fields)
            self._latest(self.user, pdf[pdf["user_sub"].notna()], ["user_sub"])
            for arrival, base, received in pdf.loc[pdf["message_type"] == "frame", ["arrival", "base_us", "received_us"]].itertuples(index=False):
                base = int(base)
                if base in fresh or base in seen:
                    duplicates += 1
                    if base not in fresh:
                        continue
                fresh[base] = min(fresh.get(base, (arrival, received)), (arrival, received))
        for base, (_, received) in fresh.items():
            seen.add(base)
            if not pd.isna(received):
                last = int(received) if last is None else max(last, int(received))
        seen.save()
        counts = (frames + len(fresh), duplicates, last, version)
        self.counts.update(counts)
        only_timer(self.handle, newest // 1000 + FORGET_MS)
        parts = [state.get()[1:] if state.exists() else (None,) * n for state, n in ((self.user, 1), (self.start, len(START_FIELDS)), (self.end, len(END_FIELDS)))]
        row = pd.DataFrame([(*key, *parts[0], *parts[1], *parts[2], *counts)], columns=[f.split()[0] for f in OUTPUT.split(", ")])
        yield row.astype({c: "Int64" for f in OUTPUT.split(", ") for c, t in [f.split()] if t == "bigint"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.seconds.clear()
        return iter([])

    def _latest(self, state, rows, fields):
        if not len(rows):
            return
        at = rows["arrival"].idxmax()
        arrival = int(rows.at[at, "arrival"])
        if not state.exists() or state.get()[0] <= arrival:
            values = [rows.at[at, c] for c in fields]
            state.update((arrival, *(None if pd.isna(v) else str(v) if TYPES.get(c, "string") == "string" else int(v) for c, v in zip(fields, values))))

    def close(self) -> None:
        pass


def roll_up_stream(records: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """The session rows of `sessions.roll_up` after every micro-batch that changes them, with `version`, which grows: write
    them in update mode through the keyed upsert, latest version wins. `records` as for the batch form, `arrival` in microseconds. Redelivered
    records change nothing but the count of duplicates. After a silent day a session's bitmaps leave the state; its row of a
    few hundred bytes stays, for a later message must not start the counts anew."""
    known = records.where(F.col("message_type").isin("session_start", "session_end", "frame"))
    integers = [c for c, t in TYPES.items() if t == "bigint"]
    typed = known.select(*KEYS, "arrival", "message_type", "user_sub", *[F.col(c).cast("bigint").alias(c) if c in integers else c for c in TYPES], F.col("base_us").cast("bigint").alias("base_us"),
                         F.col("received_us").cast("bigint").alias("received_us"))
    timed = typed.withColumn("came", F.timestamp_micros("arrival")).withWatermark("came", delay)
    return timed.groupBy(*KEYS).transformWithStateInPandas(SessionRollUp(), OUTPUT, "update", "eventTime")
