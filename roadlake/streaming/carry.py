"""Vehicle state on a stream: every signal ever seen keeps its last value, from frame to frame and over restarts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roadlake.operators.state import FRAME_US, KEYS
from roadlake.streaming.shares import SHARES, codes, pack_frame, packed, ranks, timed, unpack
from roadlake.streaming.timers import FORGET_MS, only_timer

OUTPUT = "session string, device string, names array<string>, base_us array<bigint>, start_us array<bigint>, late array<boolean>, held array<double>, seen_us array<bigint>"
ENTRIES = 1 << 16  # of a result row, which has all signals of a session for some of its intervals
NEVER = np.iinfo(np.int64).min  # the time of a signal that has not been seen yet
HELD = {"session": object, "device": object, "signal": object, "value": float, "seen_us": np.int64}
REACHED = {"session": object, "device": object, "start_us": np.int64, "arrived_ms": np.int64}


class CarryForward(StatefulProcessor):
    """State of a share of the sessions: the last value of each signal, when it was seen, and of each session the last
    interval given out and the last arrival.

    Samples are reduced to one per interval and signal, and those that are in force are looked up for all intervals of a share
    at once. An interval that comes after a later one is marked late: it has its own signals only."""

    def __init__(self, interval_us: int, frame_us: int, forget_ms: int) -> None:
        self.interval_us, self.frame_us, self.forget_ms = interval_us, frame_us, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.carry = handle.getValueState("carry", "rows binary")
        self.reached = handle.getValueState("reached", "rows binary")

    def handleInitialState(self, key, initialState, timerValues):
        """The last rows of the share's sessions in the table, a row for each signal, or one without a signal; a session keeps them
        until its first arrival."""
        rows = unpack(initialState["payload"]).to_pandas()
        sessions = rows[["session", "device", "start_us"]].drop_duplicates().assign(arrived_ms=np.iinfo(np.int64).max)
        self._put(self.reached, REACHED, pd.concat([self._get(self.reached, REACHED), sessions]))
        self._put(self.carry, HELD, pd.concat([self._get(self.carry, HELD), rows.loc[rows["signal"].notna(), list(HELD)]]))

    def handleInputRows(self, key, rows, timerValues):
        new = unpack(p for pdf in rows for p in pdf["payload"]).to_pandas()
        old, reached = self._get(self.carry, HELD), self._get(self.reached, REACHED)
        n_old, n_reached = len(old), len(reached)
        session, device = (np.concatenate([frame[c].to_numpy(object) for frame in (old, reached, new)]) for c in KEYS)
        who = codes(session, device)
        n_who = int(who.max()) + 1
        first = np.full(n_who, len(who))
        np.minimum.at(first, who, np.arange(len(who)))
        w_old, w_reached, w_new = np.split(who, [n_old, n_old + n_reached])

        # the intervals of all frames that came, by session and time
        base_us = new["base_us"].to_numpy(np.int64)
        order = np.lexsort((base_us, w_new))
        fresh = np.append(True, (np.diff(w_new[order]) != 0) | (np.diff(base_us[order]) != 0))
        frames = order[fresh]
        steps = np.arange(0, self.frame_us, self.interval_us)
        w, base, start = np.repeat(w_new[frames], len(steps)), np.repeat(base_us[frames], len(steps)), (base_us[frames][:, None] + steps).ravel()
        order = np.lexsort((base, start, w))
        w, base, start = w[order], base[order], start[order]
        again = np.append(False, (np.diff(w) == 0) & (np.diff(start) == 0))
        last = np.full(n_who, NEVER)
        last[w_reached] = reached["start_us"].to_numpy(np.int64)
        late = again | (start <= last[w])
        place = np.cumsum(~again)  # of an interval; nought is what was held before
        n_places = int(place[-1]) + 1

        # the last sample of each interval and signal
        offset = new["t_us"].to_numpy(np.int64) - base_us
        mine = new["signal"].notna().to_numpy() & new["value"].notna().to_numpy() & (offset < self.frame_us)
        t = new["t_us"].to_numpy(np.int64)[mine]
        at = base_us[mine] + np.maximum(0, offset[mine] // self.interval_us) * self.interval_us
        time, _ = ranks(np.concatenate([start, at]))
        n_times = int(time.max()) + 1
        times = w * n_times + time[: len(start)]
        place_of = place[np.searchsorted(times, w_new[mine] * n_times + time[len(start) :])]
        signal, names = ranks(np.concatenate([old["signal"].to_numpy(object), new["signal"].to_numpy(object)[mine]]))
        slots, slot = np.unique(np.concatenate([w_old, w_new[mine]]) * (len(names) + 1) + signal, return_inverse=True)
        spot = np.concatenate([np.zeros(n_old, np.int64), place_of])
        value = np.concatenate([old["value"].to_numpy(float), new["value"].to_numpy(float)[mine]])
        seen = np.concatenate([old["seen_us"].to_numpy(np.int64), t])
        order = np.lexsort((seen, spot, slot))
        here = slot[order] * n_places + spot[order]
        order = order[np.append(np.diff(here) != 0, True)[: len(order)]]
        slot, spot, value, seen = slot[order], spot[order], value[order], seen[order]
        here = slot * n_places + spot

        # one that was seen before what is held already is not held
        rank, _ = ranks(seen)
        rank += slot * (len(seen) + 1)
        holds = rank == np.maximum.accumulate(rank)
        held = np.flatnonzero(holds)

        w_slot = slots // (len(names) + 1)
        slot_names = names[slots % (len(names) + 1)]
        ends = np.searchsorted(w_slot, np.arange(n_who + 1))
        for piece in self._pieces(w, np.diff(ends)):
            yield self._rows(piece, (w, base, start, late, place), (session[first], device[first], slot_names, ends, n_places), (here, held, slot, value, seen))

        final = held[np.append(np.diff(slot[held]) != 0, True)[: len(held)]]
        whose = first[w_slot[slot[final]]]
        self._put(self.carry, HELD, pd.DataFrame({"session": session[whose], "device": device[whose], "signal": slot_names[slot[final]], "value": value[final], "seen_us": seen[final]}))
        np.maximum.at(last, w, start)
        arrived = np.full(n_who, NEVER)
        np.maximum.at(arrived, w_new, new["arrived_us"].to_numpy(np.int64) // 1000)
        quiet = arrived[w_reached] == NEVER
        arrived[w_reached[quiet]] = reached["arrived_ms"].to_numpy(np.int64)[quiet]
        self._put(self.reached, REACHED, pd.DataFrame({"session": session[first], "device": device[first], "start_us": last, "arrived_ms": arrived}))
        self._timer(arrived)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        reached = self._get(self.reached, REACHED)
        now = timerValues.getCurrentWatermarkInMs()
        old = reached["arrived_ms"] <= now - self.forget_ms
        if old.any():
            held = self._get(self.carry, HELD)
            known = pd.MultiIndex.from_frame(reached.loc[~old, KEYS])
            self._put(self.carry, HELD, held[pd.MultiIndex.from_frame(held[KEYS]).isin(known)])
            self._put(self.reached, REACHED, reached[~old])
        self._timer(reached.loc[~old, "arrived_ms"].to_numpy(np.int64), now + 1)
        return iter([])

    def _timer(self, arrived, soonest=0):
        arrived = arrived[arrived < np.iinfo(np.int64).max]
        if len(arrived):
            only_timer(self.handle, max(int(arrived.min()) + self.forget_ms, soonest))

    @staticmethod
    def _get(state, types):
        rows = unpack(state.get()).to_pandas() if state.exists() else pd.DataFrame(columns=list(types))
        return rows.astype(types)

    @staticmethod
    def _put(state, types, rows):
        if len(rows):
            state.update((pack_frame(rows[list(types)].astype(types)),))
        else:
            state.clear()

    @staticmethod
    def _pieces(w, n_slots):
        """The intervals in runs of one session each, of at most `ENTRIES` values where a session has fewer signals, and
        a list of runs of about as many together."""
        edge = np.flatnonzero(np.append(True, np.diff(w) != 0))
        runs, size = [], 0
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(w)]):
            signals = max(1, int(n_slots[w[a]]))
            step = max(1, ENTRIES // signals)
            for c in range(a, b, step):
                runs.append((c, min(c + step, b)))
                size += (runs[-1][1] - c) * signals
                if size >= 8 * ENTRIES:
                    yield runs
                    runs, size = [], 0
        if runs:
            yield runs

    @staticmethod
    def _rows(runs, intervals, sessions, samples):
        """A row for each run: what its intervals show, by interval and signal."""
        (w, base, start, late, place), (session, device, names, ends, n_places), (here, held, slot, value, seen) = intervals, sessions, samples
        a, b = runs[0][0], runs[-1][1]
        signals = (ends[w[a:b] + 1] - ends[w[a:b]]).astype(np.int64)
        stops = np.cumsum(signals)
        row = np.repeat(np.arange(a, b), signals)
        column = np.arange(len(row)) - np.repeat(stops - signals, signals) + ends[w[row]]
        wanted = column * n_places + place[row]
        exact = late[row]
        found = np.full(len(row), -1)
        if len(here):
            found[~exact] = np.append(held, -1)[np.searchsorted(here[held], wanted[~exact], side="right") - 1]
            found[exact] = np.searchsorted(here, wanted[exact], side="right") - 1
            bad = (found < 0) | (slot[found] != column) | (exact & (here[found] != wanted))
        else:
            bad = found < 0
        shown = np.where(bad, np.nan, value[found] if len(here) else np.nan)
        when = np.where(bad, NEVER, seen[found] if len(here) else NEVER)
        stops = np.append(0, stops)
        out = {c: [] for c in ("session", "device", "names", "base_us", "start_us", "late", "held", "seen_us")}
        for c, d in runs:
            k, (e, f) = w[c], (stops[c - a], stops[d - a])
            for name, part in zip(out, (session[k], device[k], names[ends[k] : ends[k + 1]], base[c:d], start[c:d], late[c:d], shown[e:f], when[e:f])):
                out[name].append(part)
        return pd.DataFrame(out)

    def close(self) -> None:
        pass


def frame_arrays(samples: DataFrame) -> DataFrame:
    """Samples (session, device, base_us, t_us, seq, signal, value) as one row per frame, its samples as arrays in order."""
    grouped = samples.groupBy(*KEYS, "base_us").agg(F.array_sort(F.collect_list(F.struct("t_us", "seq", "signal", "value"))).alias("s"))
    return grouped.select(*KEYS, "base_us", F.col("s.t_us").alias("times"), F.col("s.signal").alias("signals"), F.col("s.value").alias("samples"))


def carry_stream(frames: DataFrame, interval_us: int = FRAME_US, frame_us: int = FRAME_US, written: DataFrame | None = None, delay: str = "10 seconds",
                 forget_ms: int = FORGET_MS, shares: int = SHARES) -> DataFrame:
    """State rows of closed frames as they come, in time order per session: session, device, base_us, start_us, `signals`,
    `carried` (ages in ms of those not seen in the interval), `seen` (when each was) and `late`.

    `frames`: session, device, base_us, arrived_us and the arrays times, signals and samples (see `frame_arrays`). `written` is the
    table of an earlier run, from whose last row a session goes on; so a stream whose history is lost repeats nothing
    and forgets nothing. A session silent for `forget_ms` of arrival time leaves the state."""
    before = None if written is None else packed(last_rows(written), KEYS, shares).groupBy("share")
    flat = frames.select(*KEYS, "base_us", "arrived_us", F.explode_outer(F.arrays_zip("times", "signals", "samples")).alias("s"))
    samples = flat.select(*KEYS, "base_us", "arrived_us", F.coalesce("s.times", "base_us").alias("t_us"), F.col("s.signals").alias("signal"), F.col("s.samples").alias("value"))
    dealt = timed(packed(samples, KEYS, shares), delay)
    runs = dealt.groupBy("share").transformWithStateInPandas(CarryForward(interval_us, frame_us, forget_ms), OUTPUT, "append", "eventTime", before)
    n = F.size("names")
    rows = runs.select(*KEYS, "names", "held", "seen_us", F.posexplode(F.arrays_zip("base_us", "start_us", "late")).alias("i", "r"))
    mine = rows.select(*KEYS, "r.*", "names", *[F.slice(c, F.col("i") * n + 1, n).alias(c) for c in ("held", "seen_us")])
    shown = mine.select(*KEYS, "base_us", "start_us", "late", F.filter(F.arrays_zip("names", "held", "seen_us"), lambda x: x["seen_us"] > NEVER).alias("e"))
    old = F.filter("e", lambda x: x["seen_us"] < F.col("start_us"))
    end = F.col("start_us") + interval_us
    return shown.select(
        *KEYS, "base_us", "start_us", F.map_from_arrays("e.names", "e.held").alias("signals"),
        F.map_from_entries(F.transform(old, lambda x: F.struct(x["names"], F.floor((end - x["seen_us"]) / 1000)))).alias("carried"),
        F.map_from_arrays("e.names", "e.seen_us").alias("seen"), "late",
    )


def last_rows(written: DataFrame) -> DataFrame:
    """The last row of each session of a table that `carry_stream` wrote, a row for each of its signals: one partial aggregation."""
    last = written.where("NOT late").groupBy(*KEYS).agg(F.max_by(F.struct("start_us", "signals", "seen"), "start_us").alias("r"))
    rows = last.select(*KEYS, F.col("r.start_us").alias("start_us"), F.col("r.seen").alias("seen"), F.explode_outer("r.signals").alias("signal", "value"))
    return rows.select(*KEYS, "start_us", "signal", "value", F.try_element_at("seen", "signal").alias("seen_us"))
