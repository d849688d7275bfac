"""Frames that wait for their session's dimension row: bounded, in order, and written once."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roadlake.streaming.shares import pack, packed, ranks, timed, unpack
from roadlake.streaming.timers import FORGET_MS, SeenTimes, only_timer

WAIT_MS = 30_000  # fixed value: how long a frame waits for its session to be known
OUTPUT = "session string, device string, base_us bigint, status string, outcome string, vehicle_id bigint, user_sub string"
FRAME = ["base_us", "arrived_us", "status"]
VERSIONS = pa.schema({"arrived_us": pa.int64(), "vehicle_id": pa.int64(), "user_sub": pa.string()})


class DimensionWait(StatefulProcessor):
    """State of a session: frames that wait, the versions of its dimension row, and which frames have been written.

    Both kinds of records come in one keyed stream. A frame whose session is known goes on with the version in force when
    it is written: when it comes, or when the first version comes. If none comes within the wait, counted on the clock of
    arrival, it goes on without. Frames leave in the order of their time, so one that waits holds later ones back.

    Rows come packed, and the frames of a micro-batch are decided at once: a session's state is read and written as a whole, and
    of what has been written only the days that frames are of."""

    def __init__(self, wait_ms: int = WAIT_MS, forget_ms: int = FORGET_MS) -> None:
        self.wait_us, self.forget_ms = wait_ms * 1000, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "frames binary")
        self.versions = handle.getValueState("versions", "rows binary")
        self.clock = handle.getValueState("clock", "arrived_us bigint, first_known_us bigint")
        self.written = handle.getMapState("written", *SeenTimes.STATE)

    def handleInitialState(self, key, initialState, timerValues):
        """Frames that the table already has: session, device, base_us."""
        written = SeenTimes(self.written)
        written.add(initialState["base_us"].dropna().to_numpy(np.int64))
        written.save()

    def handleInputRows(self, key, rows, timerValues):
        records = unpack(p for pdf in rows for p in pdf["payload"])
        seen, known = self._clock()
        seen = max(seen, pc.max(records["arrived_us"]).as_py())
        dimensions = records.filter(pc.equal(records["kind"], "dimension")).select(VERSIONS.names).cast(VERSIONS)
        if len(dimensions):
            known = min([pc.min(dimensions["arrived_us"]).as_py()] + ([known] if known >= 0 else []))
        self.clock.update((seen, known))
        versions = self._versions(dimensions)
        frames = records.filter(pc.equal(records["kind"], "frame"))
        written, held = SeenTimes(self.written), self._held()
        base, at, status = (frames[c].to_numpy() for c in FRAME)
        order = np.lexsort((ranks(status)[0], base, at))
        base, at, status = base[order], at[order], status[order]
        before = written.has(base) | np.isin(base, held[0])
        empty, places = status == "empty", np.arange(len(base))
        fresh = np.flatnonzero(~before & ~empty)
        first, which = np.unique(base[fresh], return_index=True)
        holds = np.append(fresh[which], len(base))[np.searchsorted(first, base)]
        same = base == np.append(first, 0)[np.searchsorted(first, base)]
        mine = places == holds  # the first that is not empty of those of one time is held, the others were there before
        replayed = before | (same & (places > holds))
        at_once = replayed | (empty & ~mine)
        if at_once.any():
            yield self._rows(key, base[at_once], status[at_once], np.where(replayed, "replayed", "empty")[at_once])
        held = tuple(np.concatenate([old, new[mine]]) for old, new in zip(held, (base, at, status)))
        out = self._release(key, written, held, versions, len(dimensions) > 0, None)
        if out is not None:
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        out = self._release(key, SeenTimes(self.written), self._held(), self._versions(), False, now)
        if out is not None:
            yield out
        elif not self.held.exists() and now >= self._clock()[0] + self.forget_ms * 1000:
            for state in (self.versions, self.clock, self.written):
                state.clear()

    def _clock(self):
        return self.clock.get() if self.clock.exists() else (-1, -1)

    def _held(self):
        """Frames that wait: base_us, arrived_us and status."""
        if not self.held.exists():
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)
        frames = unpack(self.held.get())
        return tuple(frames[c].to_numpy() for c in FRAME)

    def _versions(self, new=None):
        """The versions of the session's row in their order, those of one arrival by vehicle."""
        tables = ([unpack(self.versions.get())] if self.versions.exists() else []) + ([new] if new is not None and len(new) else [])
        rows = pa.concat_tables(tables or [pa.table([[], [], []], VERSIONS)])
        return rows.take(pa.array(np.lexsort((pc.fill_null(rows["vehicle_id"], -1).to_numpy(), rows["arrived_us"].to_numpy()))))

    def _rows(self, key, base, status, outcome, versions=None, which=None):
        """Frames with what became of them, and of the versions the one at `which` unless that is negative."""
        out = pd.DataFrame({"session": key[0], "device": key[1], "base_us": base, "status": status, "outcome": outcome})
        if versions is None:
            return out.assign(vehicle_id=pd.array([None] * len(out), "Int64"), user_sub=None)
        rows = versions.take(pa.array(which, mask=which < 0))
        return out.assign(vehicle_id=rows["vehicle_id"].to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get).to_numpy(object), user_sub=rows["user_sub"].to_numpy()).astype({"vehicle_id": "Int64"})

    def _release(self, key, written, held, versions, grown, now):
        """Frames that need not wait, in order, up to the first that must. The earliest deadline is the next timer."""
        seen, known = self._clock()
        order = np.argsort(held[0], kind="stable")
        base, at, status = (c[order] for c in held)
        in_time = (known >= 0) & (known <= at + self.wait_us)
        goes = np.full(len(at), known >= 0) if now is None else (now >= at + self.wait_us) | (known >= 0)
        n = len(base) if goes.all() else int(goes.argmin())
        out, came = None, versions["arrived_us"].to_numpy()
        if n:
            vehicle = pc.fill_null(versions["vehicle_id"], -1).to_numpy()
            tie = np.append(False, (np.diff(came) == 0) & (np.diff(vehicle) == 0))[: len(came)]
            first = np.maximum.accumulate(np.where(tie, 0, np.arange(len(came))))
            last = np.searchsorted(came, np.maximum(at[:n], known), side="right") - 1
            which = np.where(in_time[:n], np.append(first, -1)[last], -1)
            out = self._rows(key, base[:n], status[:n], np.where(in_time[:n], "known", "unknown"), versions, which)
            written.add(base[:n])
        written.save()
        if n < len(base):
            self.held.update((pack(pa.table([base[n:], at[n:], pa.array(status[n:], pa.string())], FRAME)),))
        elif self.held.exists():
            self.held.clear()
        cut = min([seen, *at[n:].tolist()])
        unneeded = max(int(np.searchsorted(came, cut, side="right")) - 1, 0)
        if grown or unneeded:
            self.versions.update((pack(versions.slice(unneeded)),))
        due = (int(at[n]) + self.wait_us) // 1000 + 1 if n < len(base) else seen // 1000 + self.forget_ms
        only_timer(self.handle, due if now is None else max(due, now // 1000 + 1))
        return out

    def close(self) -> None:
        pass


def wait_for_dimension(records: DataFrame, wait_ms: int = WAIT_MS, delay: str = "10 seconds", written: DataFrame | None = None,
                       forget_ms: int = FORGET_MS) -> DataFrame:
    """One row per frame with what became of it: `known`, `unknown` (written without the session's columns), `empty`, or
    `replayed` (written before).

    `records`: session, device, kind (`frame`, `dimension`, or another that only moves the clock), arrived_us, base_us and
    status of frames, vehicle_id and user_sub of dimension rows. `written` has session, device and base_us of the
    frames in the table that a stream without its own history goes on with. Nothing is dropped: the watermark is on arrival.
    A session silent for `forget_ms` of arrival time leaves the state, its row and what has been written with it."""
    columns = ["kind", *FRAME, "vehicle_id", "user_sub"]
    dealt = timed(packed(records.select("session", "device", *columns), ["session", "device"], None), delay)
    before = None if written is None else written.select("session", "device", "base_us").groupBy("session", "device")
    return dealt.groupBy("session", "device").transformWithStateInPandas(DimensionWait(wait_ms, forget_ms), OUTPUT, "append", "eventTime", before)
