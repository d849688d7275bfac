"""Which bits of an unknown CAN id carry a known quantity: reference channels, lagged correlation, ranking."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.operators import asof
from roadlake.operators.inventory import ID, MINUTE_MS, SESSION, byte_inventory, id_inventory, moving_ids, with_words
from roadlake.operators.ordered import prev, scan
from roadlake.session import broadcast_if_measured, cut_lineage, spread

GPS_GAP_MS = 5_000
PAIR = [*ID, "channel"]
BLOCK = 65_536  # grid points that are reduced at once


@dataclass(frozen=True)
class Search:
    """The search's defaults."""

    lengths: tuple[int, ...] = (8, 12, 16)
    grid_ms: int = 200
    max_lag_ms: int = 2_000
    threshold: float = 0.8
    max_results: int = 12

    @property
    def max_lag(self) -> int:
        return self.max_lag_ms // self.grid_ms


def reference_channels(gps: DataFrame, gyro: DataFrame, chunk: int = MINUTE_MS) -> DataFrame:
    """Ground truth per session (session, device, channel, t_ms, seq, value): GPS speed, its derivative at midpoints,
    the gyro axis that varies most, and speed times yaw.

    `gps`: t_ms, seq, speed_kph; `gyro`: t_ms, seq, x, y, z."""
    enough_gps = gps.groupBy(*SESSION).agg(F.count("*").alias("_n")).where("_n >= 2").select(*SESSION)
    enough_gyro = gyro.groupBy(*SESSION).agg(
        F.count("*").alias("_n"), *[F.var_pop(a).alias(f"v{a}") for a in "xyz"]
    ).where("_n >= 2")
    axis = F.when((F.col("vz") >= F.col("vy")) & (F.col("vz") >= F.col("vx")), "z").when(F.col("vy") >= F.col("vx"), "y").otherwise("x")
    fixes = gps.join(enough_gps, SESSION, "left_semi")

    def channel(df: DataFrame, name: str, t: Column, value: Column) -> DataFrame:
        return df.select(*SESSION, F.lit(name).alias("channel"), t.cast("long").alias("t_ms"), "seq", value.alias("value"))

    steps = scan(fixes, SESSION, ["t_ms", "seq"], {"before": prev(F.struct("t_ms", "speed_kph"))}, chunk)
    dt = F.col("t_ms") - F.col("before.t_ms")
    accel = channel(
        steps.where((dt > 0) & (dt <= GPS_GAP_MS)), "long_accel_m_s2", F.floor((F.col("t_ms") + F.col("before.t_ms")) / 2),
        (F.col("speed_kph") - F.col("before.speed_kph")) / 3.6 / (dt / 1000.0),
    )
    enough_accel = accel.groupBy(*SESSION).agg(F.count("*").alias("_n")).where("_n >= 2").select(*SESSION)
    turning = gyro.join(enough_gyro.select(*SESSION, axis.alias("_axis")), SESSION)
    rate = F.when(F.col("_axis") == "x", F.col("x")).when(F.col("_axis") == "y", F.col("y")).otherwise(F.col("z"))
    yaw = turning.select(*SESSION, "t_ms", "seq", rate.alias("rate"))
    with_speed = asof.interpolate(yaw.join(enough_gps, SESSION, "left_semi"), fixes, SESSION, "t_ms", "seq", F.col("speed_kph"), "speed", chunk)
    return (
        channel(fixes, "speed_kph", F.col("t_ms"), F.col("speed_kph"))
        .unionByName(accel.join(enough_accel, SESSION, "left_semi"))
        .unionByName(channel(yaw, "yaw_rate_deg_s", F.col("t_ms"), F.col("rate")))
        .unionByName(channel(with_speed, "lat_accel_m_s2", F.col("t_ms"), F.col("speed") / 3.6 * F.radians("rate")))
    )


def pair_status(frames: DataFrame, ids: DataFrame, reference: DataFrame, search: Search = Search()) -> DataFrame:
    """Every id with every channel of its session: overlap, and why a pair is not searched (null when it is)."""
    seen = frames.groupBy(*ID).agg(F.count("*").alias("frames"), F.min("t_ms").alias("f0"), F.max("t_ms").alias("f1")).join(
        ids.select(*ID, "dlc"), ID)
    refs = reference.groupBy(*SESSION, "channel").agg(
        F.count("*").alias("points"), F.var_pop("value").alias("variance"), F.min("t_ms").alias("r0"), F.max("t_ms").alias("r1"))
    t0, t1 = F.greatest("f0", "r0"), F.least("f1", "r1")
    status = (
        F.when((F.col("frames") < 5) | (F.col("dlc") == 0), "NO_FRAMES")
        .when(F.col("points") < 5, "NO_REFERENCE")
        .when(F.col("variance") < 1e-6, "REFERENCE_STATIC")
        .when(t1 - t0 < search.grid_ms * 5, "NO_OVERLAP")
    )
    return seen.join(refs, SESSION).select(*PAIR, "dlc", t0.alias("t0"), t1.alias("t1"), status.alias("status"))


def _fields(dlc: int, lengths: tuple[int, ...]) -> list[tuple[int, bool, int, int]]:
    """(length, little_endian, start, right shift of the field in its word) of every field inside `dlc` bytes."""
    out = []
    for length in lengths:
        for start in range(dlc * 8):
            if start + length <= dlc * 8:
                out.append((length, True, start, start))
            top = start // 8 * 8 + 7 - start % 8
            if top + length <= dlc * 8:
                out.append((length, False, start, 64 - top - length))
    return out


WORD, REFERENCE, HEAD = 0, 1, 2


def block_rows(numbered: DataFrame, words: DataFrame, reference: DataFrame, search: Search, block: int, chunk: int) -> DataFrame:
    """What each block of a pair's grid needs, as narrow rows (pair, block, kind, time, ...): the payloads and the reference samples
    that lie in it, each with the sample before it, and one head with the pair's bounds.

    The grid itself is never a table. A sample and the one before it reach every block between them, so a block that begins
    within a gap knows the last sample before its start; `numbered`, a row per pair, is broadcast."""
    span, reach = block * search.grid_ms, search.max_lag * search.grid_ms
    last_block = F.floor(F.col("last") / block)

    def placed(rows: DataFrame, keys: list[str], kind: int, reach: int, **columns: Column) -> DataFrame:
        first = F.floor((F.coalesce("before.t_ms", "t_ms") - F.col("t0") - reach) / span)
        final = F.floor((F.col("t_ms") - F.col("t0") + reach) / span)
        met = rows.join(numbered, keys).withColumn("_a", F.greatest(first, F.lit(0))).withColumn("_b", F.least(final, last_block)).where("_a <= _b")
        return met.select("pair", F.explode(F.sequence("_a", "_b")).alias("block"), F.lit(kind).alias("kind"), F.col("t_ms").alias("t"), F.col("seq").cast("long").alias("seq"),
                          F.col("before.t_ms").alias("t_before"), *[c.alias(n) for n, c in columns.items()])

    none_long, none = F.lit(None).cast("long"), F.lit(None).cast("double")
    known = scan(reference, [*SESSION, "channel"], ["t_ms", "seq"], {"before": prev(F.struct("t_ms", "value"))}, chunk)
    payload = placed(words, ID, WORD, 0, word=F.col("word"), word_before=F.col("before.word"), value=none, value_before=none)
    values = placed(known, [*SESSION, "channel"], REFERENCE, reach, word=none_long, word_before=none_long, value=F.col("value"), value_before=F.col("before.value"))
    heads = numbered.select(
        "pair", F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("block"), F.lit(HEAD).alias("kind"), F.col("t0").alias("t"), F.col("last").alias("seq"),
        none_long.alias("t_before"), F.col("dlc").cast("long").alias("word"), none_long.alias("word_before"), none.alias("value"), none.alias("value_before"))
    return payload.unionByName(values).unionByName(heads)


@cache
def _weights(dlc: int, lengths: tuple[int, ...]) -> np.ndarray:
    """Every field, unsigned then signed, as a sum of the payload's 64 bits, the highest first."""
    rows = []
    for length, little_endian, start, shift in _fields(dlc, lengths):
        at = [56 - 8 * (k // 8) + k % 8 if little_endian else k for k in range(shift, shift + length)]
        row = np.zeros(64)
        row[[63 - k for k in at]] = 2.0 ** np.arange(length)
        signed = row.copy()
        signed[63 - at[-1]] *= -1
        rows += [row, signed]
    return np.array(rows).reshape(-1, 64)


def _samples(part: dict[str, np.ndarray], kind: int, value: str) -> tuple[np.ndarray, np.ndarray]:
    """(times, values) of a block's samples in order, the one before the first of them in front."""
    own = np.flatnonzero(part["kind"] == kind)
    own = own[np.lexsort((part["seq"][own], part["t"][own]))]
    if len(own) and part["has_before"][own[0]]:
        return np.append(part["t_before"][own[0]], part["t"][own]), np.append(part[f"{value}_before"][own[0]], part[value][own])
    return part["t"][own], part[value][own]


_PARTIAL = "pair long, field int, lag int, n long, sx double, sy double, sxx double, syy double, sxy double, ones long, zeros long"
SLICE = 8192


def _partial_sums(search: Search, block_size: int):
    """Per block of one pair's grid: the sums every field and lag need.

    A field is a weighted sum of bits, so its products with the reference follow from those of the 64 bits, and its square from
    the products of bits with each other: two matrix products a block, whatever the number of fields."""
    max_lag, grid_ms = search.max_lag, search.grid_ms
    lags = np.arange(-max_lag, max_lag + 1)
    wide = len(lags)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = {c: (pc.fill_null(table.column(c), 0) if c not in ("value", "value_before") else table.column(c)).to_numpy() for c in table.column_names}
        part["has_before"] = pc.is_valid(table.column("t_before")).to_numpy()
        head = int(np.flatnonzero(part["kind"] == HEAD)[0])
        block, t0, last, dlc = int(key[1].as_py()), int(part["t"][head]), int(part["seq"][head]), int(part["word"][head])
        times, payloads = _samples(part, WORD, "word")
        ref_times, ref_values = _samples(part, REFERENCE, "value")
        first = block * block_size
        count = min(block_size, last + 1 - first)
        around = np.arange(first - max_lag, first + count + max_lag)
        inside = (around >= 0) & (around <= last)
        at = t0 + around * grid_ms
        a = np.clip(np.searchsorted(ref_times, at, "right") - 1, 0, None)
        b = np.minimum(a + 1, len(ref_times) - 1)
        gap = ref_times[b] - ref_times[a]
        share = (at - ref_times[a]) / np.where(gap > 0, gap, 1)
        ref = np.where(gap > 0, ref_values[a] + share * (ref_values[b] - ref_values[a]), ref_values[a])
        ref = np.where(inside, ref, 0.0)
        big = payloads[np.searchsorted(times, at[max_lag : max_lag + count], "right") - 1].astype(np.int64).view(np.uint64)

        by_lag, squares = np.zeros((64, 2 * wide)), np.zeros((64, 64))
        outside = np.zeros((wide, 64, 64))  # products of bits at points whose lagged reference lies beyond the grid
        n, sy, syy = np.zeros(wide), np.zeros(wide), np.zeros(wide)
        for k in range(0, count, SLICE):
            m = min(SLICE, count - k)
            bits = np.unpackbits(big[k : k + m].astype(">u8").view(np.uint8).reshape(m, 8), axis=1).astype(float)
            valid = sliding_window_view(inside[k : k + m + 2 * max_lag], wide).astype(float)
            y = sliding_window_view(ref[k : k + m + 2 * max_lag], wide)
            by_lag += bits.T @ np.concatenate([valid, y], axis=1)
            squares += bits.T @ bits
            for lag in np.flatnonzero((valid == 0).any(axis=0)):
                beyond = bits[valid[:, lag] == 0]
                outside[lag] += beyond.T @ beyond
            n, sy, syy = n + valid.sum(0), sy + y.sum(0), syy + (y * y).sum(0)

        weights, fields = _weights(dlc, search.lengths), _fields(dlc, search.lengths)
        size = len(weights)
        sxx = np.stack([((weights @ (squares - outside[k])) * weights).sum(1) for k in range(wide)], axis=1)
        ever, always = np.bitwise_or.reduce(big, keepdims=True), np.bitwise_and.reduce(big, keepdims=True)
        numbers, ones, zeros = [], [], []
        for length, little_endian, start, shift in fields:
            for signed in (False, True):
                numbers.append(((length * 64 + start) * 2 + little_endian) * 2 + signed)
                for word, into in ((ever, ones), (always, zeros)):
                    plain = int((word.byteswap() if little_endian else word)[0]) >> shift & (1 << length) - 1
                    into.append(plain - (plain >> (length - 1) << length) if signed else plain)
        return pa.table({
            "pair": pa.array(np.full(size * wide, key[0].as_py(), np.int64)), "field": pa.array(np.repeat(np.array(numbers, np.int32), wide)), "lag": pa.array(np.tile(lags.astype(np.int32), size)),
            "n": pa.array(np.tile(n.astype(np.int64), size)), "sx": (weights @ by_lag[:, :wide]).ravel(), "sy": np.tile(sy, size), "sxx": sxx.ravel(), "syy": np.tile(syy, size),
            "sxy": (weights @ by_lag[:, wide:]).ravel(), "ones": pa.array(np.repeat(np.array(ones, np.int64), wide)), "zeros": pa.array(np.repeat(np.array(zeros, np.int64), wide))})

    return run


def correlate(pairs: DataFrame, words: DataFrame, reference: DataFrame, search: Search = Search(), block: int = BLOCK, chunk: int = MINUTE_MS) -> DataFrame:
    """Candidate fields of every searchable pair: best lag, r, factor, offset, samples, fixed low bits.

    `words` are frames as `with_words` gives them. The held payload and the interpolated reference are found on the pair's grid
    in steps of `grid_ms`. The correlation needs only sums, so a pair is not one group: its grid is cut into blocks; every block is
    reduced in numpy from the samples it covers, and the sums are added up by Spark."""
    last = F.floor((F.col("t1") - F.col("t0")) / search.grid_ms)
    numbered = pairs.where("status IS NULL").select(*PAIR, "dlc", "t0", last.alias("last"), F.monotonically_increasing_id().alias("pair"))
    numbered = broadcast_if_measured(numbered, F.lit(160))
    rows = block_rows(numbered, words, reference, search, block, chunk)
    sums = spread(rows, "pair", "block").groupBy("pair", "block").applyInArrow(_partial_sums(search, block), _PARTIAL)
    code = F.col("field")
    field = {"length": F.floor(code / 256).cast("int"), "little_endian": code.bitwiseAND(2) > 0, "start": F.floor(code / 4).cast("int") % 64, "signed": code.bitwiseAND(1) > 0}
    total = sums.groupBy("pair", "field", "lag").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")], F.bit_or("ones").alias("ones"), F.bit_and("zeros").alias("zeros")
    )
    total = total.join(numbered.select("pair", *PAIR), "pair").withColumns(field).drop("field")
    field = list(field)
    n = F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    vx, vy = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    scale = F.sqrt(F.greatest(vx, F.lit(0.0))) * F.sqrt(F.greatest(vy, F.lit(0.0)))
    r = F.when((n < 3) | (scale < 1e-9), 0.0).otherwise(cov / F.nullif(scale, F.lit(0.0)))
    slope = F.when(vx < 1e-9, 0.0).otherwise(cov / F.nullif(vx, F.lit(0.0)))
    judged = total.where(n > 0).select(
        *PAIR, *field, "lag", "n", "ones", "zeros", (vx / n).alias("spread"), r.alias("r"), slope.alias("factor"),
        (F.col("sy") / n - slope * F.col("sx") / n).alias("offset"),
    )
    best = judged.groupBy(*PAIR, *field).agg(
        F.max(F.when(F.col("lag") == 0, F.col("spread"))).alias("spread"),
        F.max_by(F.struct("r", "lag", "factor", "offset", "n"), F.struct(F.abs("r"), -F.col("lag"))).alias("b"),
        F.max("ones").alias("ones"), F.max("zeros").alias("zeros"),
    )
    changed = F.col("ones").bitwiseXOR(F.col("zeros"))
    lowest = changed.bitwiseAND(-changed)
    fixed = F.when(changed == 0, F.col("length")).otherwise(F.least(F.col("length"), F.round(F.log2(lowest.cast("double"))).cast("int")))
    return best.where((F.col("spread") >= 1e-9) & (F.abs("b.r") >= search.threshold) & (F.col("b.n") >= 5)).select(
        *PAIR, *field, "b.r", (F.col("b.lag") * search.grid_ms).alias("lag_ms"), "b.factor", "b.offset", F.col("b.n").alias("samples"),
        fixed.alias("fixed_low_bits"),
    )


def _bits_of(length: int, little_endian: bool, start: int) -> frozenset[int]:
    if little_endian:
        return frozenset(range(start, start + length))
    first = start // 8 * 8 + 7 - start % 8
    return frozenset(p // 8 * 8 + 7 - p % 8 for p in range(first, first + length))


def _suppress(max_results: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank_no")
        kept, rows = [], []
        for row in pdf.itertuples():
            bits = _bits_of(row.length, row.little_endian, row.start)
            if any(len(bits & other) > min(len(bits), len(other)) // 2 for other in kept):
                continue
            kept.append(bits)
            rows.append(row.Index)
            if len(kept) >= max_results:
                break
        return pdf.loc[rows]

    return run


def top_candidates(candidates: DataFrame, search: Search = Search()) -> DataFrame:
    """The best candidates per pair, at most `max_results`, none sharing more than half its bits with a better one.
    A pair has at most a few hundred candidates, whatever the data, so ranking it in one group is bounded."""
    strength = F.floor(F.abs("r") * 1000)
    rank = F.row_number().over(
        _window(PAIR).orderBy(strength.desc(), F.col("length").desc(), "fixed_low_bits", F.abs("r").desc(), "start", F.col("little_endian").desc(), "signed")
    )
    ranked = candidates.withColumn("rank_no", rank)
    return ranked.groupBy(*PAIR).applyInPandas(_suppress(search.max_results), ranked.schema)


def _window(keys):
    from pyspark.sql.window import Window

    return Window.partitionBy(*keys)


def analyse(frames: DataFrame, gps: DataFrame, gyro: DataFrame, search: Search = Search(), chunk: int = MINUTE_MS) -> dict[str, DataFrame]:
    """Inventory, pair statuses and candidates of every session. `frames`: session, device, can_id, t_ms, seq, dlc,
    data_hex. Ids whose bytes never move are left out of the search."""
    words = with_words(frames, ["t_ms", "seq"], chunk)
    ids = cut_lineage(id_inventory(words))
    bytes_ = cut_lineage(byte_inventory(words, ids))
    reference = cut_lineage(reference_channels(gps, gyro, chunk))
    moving = words.join(moving_ids(bytes_), ID, "left_semi")
    pairs = cut_lineage(pair_status(moving, ids, reference, search))
    found = cut_lineage(correlate(pairs, moving, reference, search, chunk=chunk))
    hit = found.select(*PAIR).distinct().withColumn("_hit", F.lit(True))
    statuses = pairs.join(hit, PAIR, "left").select(
        *PAIR, F.coalesce("status", F.when(F.col("_hit"), "OK").otherwise("NO_MATCH")).alias("status")
    )
    return {"ids": ids, "bytes": bytes_, "reference": reference, "statuses": statuses, "found": found, "candidates": top_candidates(found, search)}
