"""The lap state machine on a stream, one state per session; its laps equal those of the relational form."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roadlake.operators.lap_machine import Profile
from roadlake.streaming.timers import FORGET_MS, only_timer

_FIELDS = {
    "epoch": "bigint", "lapping": "boolean", "anchor_lat": "double", "anchor_lon": "double", "toward": "double", "imu_sum": "double", "imu_n": "bigint",
    "imu_last": "double", "imu_ms": "bigint", "lap": "bigint", "start_ms": "bigint", "distance": "double", "top": "double", "points": "bigint", "lat": "double", "lon": "double",
}
_START = dict.fromkeys(_FIELDS, 0) | {"lapping": False}
_STATE = ", ".join(f"{n} {t}" for n, t in _FIELDS.items())
OUTPUT = ("session_key string, epoch bigint, lap_number bigint, lap_start_ms bigint, lap_end_ms bigint, lap_time_ms bigint, max_speed_kph double, "
          "avg_speed_kph double, distance_m double, gps_point_count bigint")
_RANK = {"anchor": 0, "imu": 1, "gps": 2}


def _arc(lat1, lon1, lat2, lon2):
    dy, dx = math.radians(lat2 - lat1) / 2, math.radians(lon2 - lon1) / 2
    h = math.sin(dy) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(dx) ** 2
    return 2 * 6_371_000.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def _heading(lat1, lon1, lat2, lon2):
    a, b, dx = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
    return (math.degrees(math.atan2(math.sin(dx) * math.cos(b), math.cos(a) * math.sin(b) - math.sin(a) * math.cos(b) * math.cos(dx))) + 360) % 360


def _tenth(x):
    return math.floor(x * 10 + 0.5) / 10



class LapMachine(StatefulProcessor):
    """A session's machine takes the records of a micro-batch in time order, however many frames they come in. A session
    that is silent for a day of arrival time is forgotten; its next record starts afresh, before an anchor."""

    def __init__(self, profile: Profile) -> None:
        self.profile = profile

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("lap", _STATE)

    def handleInputRows(self, key, rows, timerValues):
        s = dict(zip(_FIELDS, self.state.get())) if self.state.exists() else dict(_START)
        batch = pd.concat(list(rows))
        arrived = int(batch["arrived_us"].max()) if "arrived_us" in batch else None
        batch["rank"] = batch["kind"].map(_RANK)
        out = []
        for r in batch.sort_values(["t_ms", "rank", "seq"]).itertuples():
            lap = self._step(s, r)
            if lap:
                out.append({"session_key": key[0], **lap})
        self.state.update(tuple(s.values()))
        if arrived is not None:
            only_timer(self.handle, arrived // 1000 + FORGET_MS)
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        return iter([])

    def _step(self, s, r):
        located = not (pd.isna(r.lat) or pd.isna(r.lon))
        if r.kind == "anchor":
            if located:
                s.update(_START | {"epoch": s["epoch"] + 1, "anchor_lat": r.lat, "anchor_lon": r.lon})
            return None
        if s["epoch"] == 0:
            return None
        if r.kind == "imu":
            if self.profile.has_imu and not pd.isna(r.magnitude):
                if not s["lapping"] and s["imu_n"] < self.profile.baseline_samples:
                    s["imu_sum"] += r.magnitude
                    s["imu_n"] += 1
                s["imu_last"], s["imu_ms"] = r.magnitude, int(r.t_ms) + 1
            return None
        if not located:
            return None
        speed = None if pd.isna(r.speed) else float(r.speed)
        if not s["lapping"]:
            if self._launched(s, speed, int(r.t_ms)):
                s.update(lapping=True, lap=1, start_ms=int(r.t_ms), distance=0.0, top=speed, points=1, lat=r.lat, lon=r.lon,
                         toward=_heading(s["anchor_lat"], s["anchor_lon"], r.lat, r.lon))
            return None
        return self._drive(s, r, speed)

    def _launched(self, s, speed, t_ms):
        p = self.profile
        if speed is None or speed < p.launch_speed_kph:
            return False
        if not p.has_imu:
            return True
        if s["imu_ms"] == 0 or t_ms - (s["imu_ms"] - 1) > p.imu_staleness_ms:
            return False
        if p.gravity_compensated:
            return s["imu_last"] >= p.launch_accel
        return s["imu_n"] >= p.baseline_samples and abs(s["imu_last"] - s["imu_sum"] / s["imu_n"]) >= p.launch_accel

    def _drive(self, s, r, speed):
        p, t_ms, lap = self.profile, int(r.t_ms), None
        s["distance"] += _arc(s["lat"], s["lon"], r.lat, r.lon)
        s["top"] = max(s["top"], speed or 0.0)
        s["points"] += 1
        turn = abs(_heading(s["lat"], s["lon"], r.lat, r.lon) - s["toward"]) % 360
        near = _arc(r.lat, r.lon, s["anchor_lat"], s["anchor_lon"]) <= p.geofence_radius_m
        took = t_ms - s["start_ms"]
        if near and took >= p.min_lap_ms and min(turn, 360 - turn) <= p.bearing_tolerance_deg:
            average = (s["distance"] / 1000.0) / (took / 3_600_000.0) if took > 0 else 0.0
            lap = {"epoch": s["epoch"], "lap_number": s["lap"], "lap_start_ms": s["start_ms"], "lap_end_ms": t_ms, "lap_time_ms": took, "max_speed_kph": s["top"],
                   "avg_speed_kph": _tenth(average), "distance_m": _tenth(s["distance"]), "gps_point_count": s["points"]}
            s.update(lap=s["lap"] + 1, start_ms=t_ms, distance=0.0, top=speed or 0.0, points=0)
        s["lat"], s["lon"] = r.lat, r.lon
        return lap

    def close(self) -> None:
        pass


def laps_stream(records: DataFrame, profile: Profile = Profile(), delay: str = "10 seconds") -> DataFrame:
    """`records` as for the batch form. GPS and IMU come as one union, keyed by session. With a column `arrived_us`, whose
    watermark drops nothing that comes in its turn, silent sessions are forgotten; without one they are kept."""
    if "arrived_us" not in records.columns:
        return records.groupBy("session_key").transformWithStateInPandas(LapMachine(profile), OUTPUT, "append", "none")
    timed = records.withColumn("arrival", F.timestamp_micros("arrived_us")).withWatermark("arrival", delay)
    return timed.groupBy("session_key").transformWithStateInPandas(LapMachine(profile), OUTPUT, "append", "eventTime")
