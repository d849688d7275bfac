"""Helpers that the keyed state machines share."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql.streaming.stateful_processor import MapState, StatefulProcessorHandle

FORGET_MS = 24 * 3_600_000
HOUR_US, SECOND_US = 3_600_000_000, 1_000_000
DAY_US = 24 * HOUR_US


def only_timer(handle: StatefulProcessorHandle, at_ms: int) -> None:
    """One timer a key: the given one in place of any other."""
    for timer in list(handle.listTimers()):
        if timer != at_ms:
            handle.deleteTimer(timer)
    handle.registerTimer(at_ms)


class SeenSeconds:
    """Which times a session has had, as a bitmap of 3600 seconds for each hour and each offset within the second.

    A device that ticks once a second has one offset, so a day takes eleven kilobytes; times that differ in
    less than a second are still told apart."""

    STATE = ("hour bigint, offset bigint", "seconds binary")

    def __init__(self, state: MapState):
        self.state, self.maps = state, {}

    def _bits(self, key: tuple[int, int]) -> np.ndarray:
        if key not in self.maps:
            held = self.state.getValue(key) if self.state.containsKey(key) else None
            self.maps[key] = np.unpackbits(np.frombuffer(bytes(held[0]), np.uint8)) if held else np.zeros(3600, np.uint8)
        return self.maps[key]

    @staticmethod
    def _place(time_us: int) -> tuple[tuple[int, int], int]:
        return (time_us // HOUR_US, time_us % SECOND_US), time_us % HOUR_US // SECOND_US

    def __contains__(self, time_us: int) -> bool:
        key, second = self._place(time_us)
        return bool(self._bits(key)[second])

    def add(self, time_us: int) -> None:
        key, second = self._place(time_us)
        self._bits(key)[second] = 1

    def save(self) -> None:
        for key, bits in self.maps.items():
            if bits.any():
                self.state.updateValue(key, (np.packbits(bits).tobytes(),))
        self.maps = {}


class SeenTimes:
    """Which times a session has had, many asked and added at once: for each day the steps from one to the next, compressed.

    A device that ticks once a second takes some hundred bytes a day, one that ticks at odd times a few bytes for each."""

    STATE = ("day bigint", "steps binary")

    def __init__(self, state: MapState):
        self.state, self.days, self.changed = state, {}, set()

    def _times(self, day: int) -> np.ndarray:
        if day not in self.days:
            held = self.state.getValue((day,)) if self.state.containsKey((day,)) else None
            self.days[day] = np.cumsum(np.frombuffer(zlib.decompress(bytes(held[0])), np.int64)) if held else np.zeros(0, np.int64)
        return self.days[day]

    @staticmethod
    def _by_day(times: np.ndarray):
        """Each day with the places of its times."""
        order = np.argsort(times, kind="stable")
        days = times[order] // DAY_US
        starts = np.flatnonzero(np.append(True, np.diff(days) != 0)[: len(days)])
        return [(int(days[a]), places) for a, places in zip(starts, np.split(order, starts[1:]))]

    def has(self, times: np.ndarray) -> np.ndarray:
        out = np.zeros(len(times), bool)
        for day, places in self._by_day(times):
            out[places] = np.isin(times[places], self._times(day))
        return out

    def add(self, times: np.ndarray) -> None:
        for day, places in self._by_day(times):
            self.days[day] = np.union1d(self._times(day), times[places])
            self.changed.add(day)

    def save(self) -> None:
        for day in sorted(self.changed):
            self.state.updateValue((day,), (zlib.compress(np.diff(self.days[day], prepend=0).tobytes(), 1),))
        self.days, self.changed = {}, set()
