"""When a session's traffic is over: after its end and two quiet minutes, or thirty silent ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roadlake.operators.ordered import HOUR_US, number_runs, running_max, scan
from roadlake.streaming.shares import SHARES, codes, pack_frame, packed, timed, unpack
from roadlake.streaming.timers import only_timer

# Quiet after an end, silence without one.
END_QUIET_MS = 120_000
IDLE_MS = 1_800_000
KEYS = ["session", "device"]
FORGET_MS = 24 * 3_600_000
OUTPUT = "session string, device string, first_us bigint, last_us bigint, can_frames bigint, records bigint, ended boolean, late bigint"
STATE = {"first_us": (np.int64, 0), "last_us": (np.int64, 0), "can_frames": (np.int64, 0), "records": (np.int64, 0), "ended": (bool, False),
         "arrived_ms": (np.int64, -1), "done": (bool, False)}


class SessionClose(StatefulProcessor):
    """A small running summary of each session of a share, in the order of its records.

    A record after too long a silence closes the session before it counts, whichever micro-batch it comes in; it and all
    that follow are late and are reported as they come, in rows with a count of late records only. Without such a record
    a timer on the clock of arrival closes it. What is closed is forgotten a day later."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        new = unpack(p for pdf in rows for p in pdf["payload"]).to_pandas()
        known = self._load()
        names = [np.concatenate([known[c].to_numpy(object), new[c].to_numpy(object)]) for c in KEYS]
        who = codes(*names)
        n = int(who.max()) + 1
        where = np.full(n, len(who))
        np.minimum.at(where, who, np.arange(len(who)))
        mine, who = who[: len(known)], who[len(known) :]
        state = {c: np.full(n, v, t) for c, (t, v) in STATE.items()}
        for c, values in state.items():
            values[mine] = known[c].to_numpy()
        np.maximum.at(state["arrived_ms"], who, new["arrived_us"].to_numpy(np.int64) // 1000)

        real = (new["kind"] != TICK).to_numpy()
        t, kind = new["t_us"].to_numpy(np.int64)[real], new["kind"].to_numpy(object)[real]
        order = np.lexsort((new["seq"].to_numpy(np.int64)[real], t, who[real]))
        w, t, kind = who[real][order], t[order], kind[order]
        out = []
        if len(w):
            begins = np.flatnonzero(np.append(True, np.diff(w) != 0))
            ends, group, s = np.append(begins[1:], len(w)), np.cumsum(np.append(False, np.diff(w) != 0)), w[begins]
            places = np.arange(len(w))
            over = (np.maximum.accumulate(np.where(kind == "session_end", places, -1)) >= begins[group]) | state["ended"][w]
            before, over_before = np.append(0, t[:-1]), np.append(False, over[:-1])
            has = state["records"][s] > 0
            before[begins], over_before[begins] = np.where(has, state["last_us"][s], t[begins]), state["ended"][s]
            silent = t - before >= np.where(over_before, END_QUIET_MS, IDLE_MS) * 1000
            done = state["done"][s]
            stop = np.where(done, begins, np.minimum.reduceat(np.where(silent, places, len(w)), begins))
            stop = np.minimum(stop, ends)
            count, late = stop - begins, ends - stop
            cans = np.append(0, np.cumsum(kind == "can"))
            some, edge = count > 0, np.maximum(stop - 1, begins)
            first = np.where(has, np.minimum(state["first_us"][s], t[begins]), t[begins])
            last = np.where(has, np.maximum(state["last_us"][s], t[edge]), t[edge])
            for c, values in (("first_us", first), ("last_us", last), ("ended", over[edge])):
                state[c][s] = np.where(some, values, state[c][s])
            state["records"][s] += count
            state["can_frames"][s] += cans[stop] - cans[begins]
            closing = ~done & (late > 0)
            state["done"][s] = done | closing
            if closing.any():
                out.append(self._closed({c: v[where[s[closing]]] for c, v in zip(KEYS, names)} | {c: v[s[closing]] for c, v in state.items()}))
            if (late > 0).any():
                out.append(self._late({c: v[where[s[late > 0]]] for c, v in zip(KEYS, names)}, late[late > 0]))
        self._save(pd.DataFrame({c: v[where] for c, v in zip(KEYS, names)} | state))
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        known = self._load()
        due = (self._due(known) <= now).to_numpy()
        closing = due & ~known["done"].to_numpy()
        known["done"] |= closing
        self._save(known[~due | closing], now + 1)
        if closing.any():
            yield self._closed(known[closing])

    def _load(self):
        types = dict.fromkeys(KEYS, object) | {c: t for c, (t, _) in STATE.items()}
        rows = unpack(self.state.get()).to_pandas() if self.state.exists() else pd.DataFrame(columns=list(types))
        return rows.astype(types)

    def _save(self, known, soonest=0):
        """Sessions that have had records; of others nothing is known but ticks."""
        known = known[known["records"] > 0]
        if len(known):
            self.state.update((pack_frame(known),))
            only_timer(self.handle, max(int(self._due(known).min()), soonest))
        else:
            self.state.clear()

    @staticmethod
    def _due(known):
        """When a session is closed, or forgotten if it is."""
        return known["arrived_ms"] + np.where(known["done"], FORGET_MS, np.where(known["ended"], END_QUIET_MS, IDLE_MS))

    @staticmethod
    def _closed(rows):
        columns = ["first_us", "last_us", "can_frames", "records", "ended"]
        return pd.DataFrame({c: rows[c] for c in (*KEYS, *columns)} | {"late": 0})

    @staticmethod
    def _late(names, late):
        none = {c: pd.array([None] * len(late), "boolean" if c == "ended" else "Int64") for c in ("first_us", "last_us", "can_frames", "records", "ended")}
        return pd.DataFrame(names | none | {"late": late})

    def close(self) -> None:
        pass


TICK = "tick"  # a record that only moves the clock


def close_stream(records: DataFrame, delay: str = "10 seconds", shares: int = SHARES) -> DataFrame:
    """`records`: session, device, t_us, seq (the order of equal times), kind, arrived_us. One row per session once it is
    over, and rows with only `late` for what comes after; `totals` adds them up. The watermark is on arrival, so a device
    that uploads an old drive loses nothing."""
    moving = records.select(*KEYS, "t_us", "seq", "kind", "arrived_us")
    dealt = timed(packed(moving, KEYS, shares), delay)
    return dealt.groupBy("share").transformWithStateInPandas(SessionClose(), OUTPUT, "append", "eventTime")


def totals(closed: DataFrame) -> DataFrame:
    """One row per session of the table that `close_stream` wrote."""
    once = ["first_us", "last_us", "can_frames", "records", "ended"]
    return closed.groupBy(*KEYS).agg(*[F.max(c).alias(c) for c in once], F.sum("late").alias("late"))


def close_batch(records: DataFrame, order: list[str], chunk: int = HOUR_US) -> DataFrame:
    """The same rules over recorded traffic: the first silence long enough closes the session; what follows is late.

    The two silences differ in whether an end has been seen, so rows first learn the running end, then the runs."""

    ended = scan(records, KEYS, order, {"ended": running_max((F.col("kind") == "session_end").cast("int"))}, chunk)
    value = F.struct("t_us", "ended")

    def silent(p, c):
        limit = F.when(p["ended"] == 1, END_QUIET_MS * 1000).otherwise(IDLE_MS * 1000)
        return c["t_us"] - p["t_us"] >= limit

    runs = number_runs(ended, KEYS, order, value, silent, "run", chunk)
    mine = F.col("run") == 1
    return runs.groupBy(*KEYS).agg(
        F.min(F.when(mine, F.col("t_us"))).alias("first_us"), F.max(F.when(mine, F.col("t_us"))).alias("last_us"),
        F.count_if(mine & (F.col("kind") == "can")).alias("can_frames"), F.count_if(mine).alias("records"),
        (F.max(F.when(mine, F.col("ended"))) == 1).alias("ended"), F.count_if(~mine).alias("late"),
    )
