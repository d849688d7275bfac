"""Keyed state in shares: a call of Python and its round trips to the state are for a share of all keys, not for one key.

Rows travel to their share packed, many in one binary value, and a state machine computes on all keys of its share at once. So
the cost of a micro-batch is that of its rows and of a fixed number of calls, however many keys there are."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARES = 256  # as state is kept by share, a stream goes on only with the number it began with
ROWS = 200_000  # of a task that are dealt at a time


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def pack_frame(frame: pd.DataFrame) -> bytes:
    return pack(pa.Table.from_pandas(frame, preserve_index=False))


def unpack(parts: Iterable[bytes]) -> pa.Table | None:
    """The rows of all parts, none for no parts."""
    tables = [pa.ipc.open_stream(pa.py_buffer(bytes(p))).read_all() for p in parts]
    return pa.concat_tables(tables) if tables else None


def packed(rows: DataFrame, by: list[str], shares: int | None = SHARES, rows_at_once: int = ROWS) -> DataFrame:
    """`rows` packed by share, a hash of the columns `by`: share, arrived_us (the latest) and payload. Without `shares`, packed by the
    columns themselves, which then take the place of share and are not in the payload; for keys of many rows each. An order of rows is
    kept within a task. `arrived_us` may be missing."""
    names = ["share"] if shares else by
    columns = rows.columns if shares else [c for c in rows.columns if c not in by]
    dealt = rows.withColumn("share", F.pmod(F.xxhash64(*by), F.lit(shares)).cast("int")) if shares else rows
    types = dict(dealt.dtypes)
    ddl = ", ".join([*[f"{n} {types[n]}" for n in names], "arrived_us bigint", "payload binary"])

    def split(held):
        table = pa.Table.from_batches(held).combine_chunks()
        code = codes(*[table[n].to_numpy() for n in names])
        order = np.argsort(code, kind="stable")
        table, code = table.take(pa.array(order)), code[order]
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        parts = [table.slice(a, b - a) for a, b in zip(starts, [*starts[1:], len(code)])]
        came = [pc.max(p["arrived_us"]).as_py() if "arrived_us" in columns else None for p in parts]
        first = table.take(pa.array(starts)).combine_chunks()
        arrays = [first[n].combine_chunks() for n in names]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(came, pa.int64()), pa.array([pack(p.select(columns)) for p in parts], pa.binary())], [*names, "arrived_us", "payload"])

    def deal(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows_at_once:
                yield split(held)
                held, n = [], 0
        if n:
            yield split(held)

    return dealt.mapInArrow(deal, ddl)


def timed(dealt: DataFrame, delay: str) -> DataFrame:
    """Packed rows with the watermark on the arrival of the latest row of each."""
    return dealt.withColumn("arrival", F.timestamp_micros("arrived_us")).withWatermark("arrival", delay)


def codes(*columns) -> np.ndarray:
    """A number for each distinct row of the columns, in no meaningful order."""
    out = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        mine, values = pd.factorize(column, use_na_sentinel=False)
        out = pd.factorize(out * len(values) + mine)[0].astype(np.int64)
    return out


def ranks(column) -> tuple[np.ndarray, np.ndarray]:
    """The place of each value among the sorted distinct ones, and those."""
    mine, values = pd.factorize(column)
    order = np.argsort(values)
    place = np.empty(len(values), np.int64)
    place[order] = np.arange(len(values))
    return place[mine] if len(values) else np.zeros(len(mine), np.int64), np.asarray(values)[order]
