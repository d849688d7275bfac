"""The rate check on a stream: values in the order of their time, though they arrive in another."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roadlake.operators.validate import row_reason
from roadlake.streaming.shares import SHARES, pack, pack_frame, packed, timed, unpack
from roadlake.streaming.timers import FORGET_MS, only_timer

LATE = "LATE"
OUTPUT = "session string, signal string, seq bigint, t_us bigint, value double, reason string"


class RateCheck(StatefulProcessor):
    """State of a share of the sessions' signals: values that may yet be preceded by others, and of each signal the last value
    that passed and when it was last heard of.

    A value may come `within` after its time; what comes later is reported as late and decides nothing. So a value is due
    once the clock of arrival has passed its time by that much, and what is held is that span of a share's signals."""

    def __init__(self, limits: dict[str, float], within_us: int, forget_ms: int) -> None:
        self.limits, self.within_us, self.forget_ms = limits, within_us, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.passed = handle.getValueState("passed", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        values = unpack(p for pdf in rows for p in pdf["payload"])
        values = values.filter(pc.is_valid(values["signal"]))  # a row without a signal only moves the clock
        late = values["arrived_us"].to_numpy() - values["t_us"].to_numpy() > self.within_us
        if late.any():
            self._hear(values.filter(late), timerValues.getCurrentWatermarkInMs())
            yield self._rows(values.filter(late).to_pandas(), LATE)
        fit = values.filter(~late).select(["session", "signal", "t_us", "seq", "value"])
        if len(fit):
            self.waiting.appendValue((pack(fit),))
            due = self._ms(int(pc.min(fit["t_us"]).as_py()))
            only_timer(self.handle, min([max(due, timerValues.getCurrentWatermarkInMs() + 1), *self.handle.listTimers()]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        waiting = unpack(c for (c,) in self.waiting.get()) if self.waiting.exists() else None
        held, heard = self._passed()
        due, at = [], set()
        if waiting is not None:
            frame = waiting.to_pandas()
            is_ready = self._ms(frame["t_us"].to_numpy()) <= now
            ready, left = frame[is_ready].sort_values(["t_us", "seq", "value"]), waiting.filter(~is_ready)
            if len(left):
                self.waiting.put([(pack(left),)])
                due.append(self._ms(int(pc.min(left["t_us"]).as_py())))
                at = set(zip(left["session"].to_pylist(), left["signal"].to_pylist()))
            else:
                self.waiting.clear()
            if len(ready):
                reasons, keys = [], list(zip(ready["session"], ready["signal"]))
                for name, value in zip(keys, ready["value"].tolist()):
                    ok = name not in held or abs(value - held[name]) <= self.limits[name[1]]
                    if ok:
                        held[name] = value
                    reasons.append(None if ok else "RATE_IMPLAUSIBLE")
                heard.update(dict.fromkeys(keys, now))
                yield self._rows(ready, reasons)
        for name in [k for k, ms in heard.items() if ms + self.forget_ms <= now and k not in at]:
            del held[name], heard[name]
        due += [ms + self.forget_ms for k, ms in heard.items() if k not in at]
        self._save(held, heard)
        if due:
            only_timer(self.handle, max(min(due), now + 1))

    def _passed(self):
        """The last value that passed and when it was heard of, by session and signal."""
        if not self.passed.exists():
            return {}, {}
        rows = unpack(self.passed.get()).to_pydict()
        keys = list(zip(rows["session"], rows["signal"]))
        return dict(zip(keys, rows["value"])), dict(zip(keys, rows["heard_ms"]))

    def _save(self, held, heard):
        if not held:
            self.passed.clear()
            return
        rows = pd.DataFrame(list(held), columns=["session", "signal"])
        self.passed.update((pack_frame(rows.assign(value=np.array(list(held.values()), float), heard_ms=np.array([heard[k] for k in held], np.int64))),))

    def _hear(self, late, now):
        """A signal that sends only late values is not forgotten either."""
        held, heard = self._passed()
        known = [k for k in zip(late["session"].to_pylist(), late["signal"].to_pylist()) if k in held]
        if known:
            heard.update(dict.fromkeys(known, now))
            self._save(held, heard)

    def _ms(self, t_us):
        """When a value of that time is due."""
        return (t_us + self.within_us) // 1000 + 1

    def _rows(self, values, reason):
        return pd.DataFrame({"session": values["session"], "signal": values["signal"], "seq": values["seq"], "t_us": values["t_us"], "value": values["value"], "reason": reason})

    def close(self) -> None:
        pass


def rate_check_stream(
    samples: DataFrame, ranges: dict[str, tuple[float, float]], max_deltas: dict[str, float], within_us: int, exclude: tuple[str, ...] = (), delay: str = "0 seconds",
    forget_ms: int = FORGET_MS, shares: int = SHARES,
) -> DataFrame:
    """`samples` (session, signal, seq, t_us, value, arrived_us) with `reason`, null for what passes: the checks of `validate`,
    and `LATE` for values of limited signals that come more than `within_us` after their time.

    Only values with a limit are keyed and held; all others pass by without state. A row without a signal only moves the clock. The watermark is on arrival, so
    Spark drops nothing before it is judged, as long as arrivals are at most `delay` out of order. A signal of which nothing
    has come for `forget_ms` of arrival time starts anew, without a last value."""
    checked = samples.withColumn("reason", row_reason(ranges, exclude))
    limited = F.col("signal").isin(list(max_deltas)) & F.col("reason").isNull() & F.col("value").isNotNull()
    plain = checked.where(~limited & F.col("signal").isNotNull()).select("session", "signal", "seq", "t_us", "value", "reason")
    moving = checked.where(limited | F.col("signal").isNull()).select("session", "signal", "seq", "t_us", "value", "arrived_us")
    dealt = timed(packed(moving, ["session", "signal"], shares), delay)
    rated = dealt.groupBy("share").transformWithStateInPandas(RateCheck(max_deltas, within_us, forget_ms), OUTPUT, "append", "eventTime")
    return plain.unionByName(rated)
