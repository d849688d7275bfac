"""Order-dependent work (previous row, carry-forward, running totals, folds) that survives a hot key.

A plain window over (session) hands a whole session to one task. Here every key is cut into time chunks: rows are
windowed within (key, chunk), each chunk is summarised in one row by a partially aggregated groupBy, the small
summaries are windowed per key, and the carry of all earlier chunks is joined back. Results equal the plain window.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlake.session import cut_lineage, spread

CHUNK, RUN = "_chunk", "_run"
SPAN = 16
HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


@dataclass(frozen=True)
class Step:
    """One scanned output.

    kind: "prev"/"next" neighbour's value, "last"/"first" nearest non-null value before/after, "sum"/"max"/"min"
    running aggregate. `inclusive` says whether the current row takes part in all but prev/next.
    """

    kind: str
    value: Column
    inclusive: bool = True


def prev(value: Column) -> Step:
    return Step("prev", value)


def next_(value: Column) -> Step:
    return Step("next", value)


def last_known(value: Column, inclusive: bool = True) -> Step:
    return Step("last", value, inclusive)


def first_known(value: Column, inclusive: bool = True) -> Step:
    return Step("first", value, inclusive)


def running_sum(value: Column, inclusive: bool = True) -> Step:
    return Step("sum", value, inclusive)


def running_max(value: Column, inclusive: bool = True) -> Step:
    return Step("max", value, inclusive)


def running_min(value: Column, inclusive: bool = True) -> Step:
    return Step("min", value, inclusive)


_AGG = {"sum": F.sum, "max": F.max, "min": F.min}
_BACKWARD = {"next", "first"}


def with_chunk(df: DataFrame, time: str, chunk: int) -> DataFrame:
    return df.withColumn(CHUNK, F.floor(F.col(time) / F.lit(chunk)).cast("long"))


def _local(step: Step, ordered) -> Column:
    """The step's value seen from inside one chunk, as a struct that is null when the chunk holds no answer."""
    lo, here, hi = Window.unboundedPreceding, Window.currentRow, Window.unboundedFollowing
    boxed = F.struct(step.value.alias("v"))
    if step.kind == "prev":
        return F.lag(boxed).over(ordered)
    if step.kind == "next":
        return F.lead(boxed).over(ordered)
    known = F.when(step.value.isNotNull(), boxed)
    if step.kind == "last":
        return F.last(known, ignorenulls=True).over(ordered.rowsBetween(lo, here if step.inclusive else -1))
    if step.kind == "first":
        return F.first(known, ignorenulls=True).over(ordered.rowsBetween(here if step.inclusive else 1, hi))
    return F.struct(_AGG[step.kind](step.value).over(ordered.rowsBetween(lo, here if step.inclusive else -1)).alias("v"))


def _summary(step: Step, order: list[str]) -> Column:
    position = F.struct(*order)
    boxed = F.struct(step.value.alias("v"))
    known = F.when(step.value.isNotNull(), position)
    return {
        "prev": lambda: F.max_by(boxed, position),
        "next": lambda: F.min_by(boxed, position),
        "last": lambda: F.max_by(boxed, known),
        "first": lambda: F.min_by(boxed, known),
    }.get(step.kind, lambda: F.struct(_AGG[step.kind](step.value).alias("v")))()


def _carry(step: Step, name: str, chunks) -> Column:
    """What the other chunks of the key contribute to this chunk."""
    value = F.col(name)
    lo, hi = Window.unboundedPreceding, Window.unboundedFollowing
    if step.kind == "prev":
        return F.lag(value).over(chunks)
    if step.kind == "next":
        return F.lead(value).over(chunks)
    if step.kind == "last":
        return F.last(value, ignorenulls=True).over(chunks.rowsBetween(lo, -1))
    if step.kind == "first":
        return F.first(value, ignorenulls=True).over(chunks.rowsBetween(1, hi))
    return F.struct(_AGG[step.kind](value["v"]).over(chunks.rowsBetween(lo, -1)).alias("v"))


def _combine(step: Step, local: Column, carry: Column) -> Column:
    if step.kind == "sum":
        return F.when(
            local["v"].isNotNull() | carry["v"].isNotNull(),
            F.coalesce(local["v"], F.lit(0)) + F.coalesce(carry["v"], F.lit(0)),
        )
    if step.kind == "max":
        return F.greatest(local["v"], carry["v"])
    if step.kind == "min":
        return F.least(local["v"], carry["v"])
    return F.coalesce(local, carry)["v"]


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    steps: dict[str, Step],
    chunk: int = HOUR_US,
) -> DataFrame:
    """Add one column per step. `order[0]` is a LONG time that is cut into chunks of `chunk` units; the order
    must be total and, like the keys, free of nulls."""
    chunked = with_chunk(df, order[0], chunk)
    names = {out: f"_s{i}" for i, out in enumerate(steps)}

    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    summary = chunked.groupBy(*keys, CHUNK).agg(*[_summary(s, order).alias(names[o]) for o, s in steps.items()])
    carried = summary.select(*keys, CHUNK, *[_carry(s, names[o], chunks).alias("_c" + names[o]) for o, s in steps.items()])

    ordered = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    local = chunked.select("*", *[_local(s, ordered).alias(names[o]) for o, s in steps.items()])
    joined = local.join(carried, [*keys, CHUNK])
    kept = [F.col(c) for c in df.columns if c not in steps]
    return joined.select(
        *kept, *[_combine(s, F.col(names[o]), F.col("_c" + names[o])).alias(o) for o, s in steps.items()]
    )


def number_runs(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    starts: Callable[[Column, Column], Column],
    out: str,
    chunk: int = HOUR_US,
) -> DataFrame:
    """Number runs of rows from 1 and add the previous row's `value` as `<out>_prev`.

    `starts(previous, current)` says whether a row opens a new run. Within a chunk the neighbours are a window; the
    chunk's first row is judged on the summaries, against the last row of the chunk before."""
    chunked = with_chunk(df, order[0], chunk).withColumn("_v", F.struct(value.alias("v")))
    ordered = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    local = chunked.withColumn("_p", F.lag("_v").over(ordered))
    local = local.withColumn(
        "_n", F.sum(F.coalesce(starts(F.col("_p.v"), F.col("_v.v")) & F.col("_p").isNotNull(), F.lit(False)).cast("long")).over(
            ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    position = F.struct(*order)
    summary = local.groupBy(*keys, CHUNK).agg(
        F.min_by("_v", position).alias("_first"), F.max_by("_v", position).alias("_last"), F.max("_n").alias("_inside")
    )
    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    judged = summary.withColumn("_before", F.lag("_last").over(chunks)).withColumn(
        "_opens", F.when(F.col("_before").isNull(), 1).otherwise(
            F.coalesce(starts(F.col("_before.v"), F.col("_first.v")), F.lit(False)).cast("long"))
    )
    based = judged.select(
        *keys, CHUNK, "_before",
        (F.sum("_opens").over(chunks.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         + F.coalesce(F.sum("_inside").over(chunks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_base"),
    )
    return local.join(based, [*keys, CHUNK]).select(
        *df.columns, (F.col("_n") + F.col("_base")).alias(out), F.coalesce("_p", "_before")["v"].alias(f"{out}_prev")
    )


Rows = dict[str, np.ndarray]


def _pieces(batches: Iterable[pd.DataFrame], keys: list[str], columns: list[str]):
    """Consecutive rows of one (key, chunk) as (batch, first row, end row, key values, start state, column arrays)."""
    for pdf in batches:
        if not len(pdf):
            continue
        tags = [pdf[k].to_numpy() for k in keys]
        change = np.zeros(len(pdf), dtype=bool)
        for tag in tags:
            change[1:] |= tag[1:] != tag[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), len(pdf)]
        arrays, starts = {c: pdf[c].to_numpy() for c in columns}, pdf["_start"].to_numpy()
        for a, b in zip(edges, edges[1:]):
            yield pdf, a, b, tuple(t[a] for t in tags), starts[a], {c: v[a:b] for c, v in arrays.items()}


def chunked_fold(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    step: Callable[[Rows, dict | None], tuple[list, dict | None]],
    out: str,
    out_type: str,
    chunk: int = HOUR_US,
) -> DataFrame:
    """A sequential fold whose state is small, for rules no window expresses.

    `step(rows, state)` sees consecutive rows of one chunk, in order, and returns one output per row and the state
    after them. The columns it needs are written once, sorted by chunk, and read from there. Chunks are first folded
    each from an empty state. Where the state handed over by the chunk before differs from the one used, chunks are
    folded again, in order from the first such chunk to the end of a block of SPAN chunks, then of SPAN^2, and so on
    until nothing differs: exact, in a number of rounds that is the logarithm of a key's chunks even if every chunk
    depends on the first. Rows stream through sorted partitions, so not even a chunk is held in memory."""
    source = with_chunk(df, order[0], chunk)
    by_chunk = [*keys, CHUNK]
    used = list(dict.fromkeys([*order, *columns, *keys]))

    def load(text):
        return json.loads(text) if isinstance(text, str) else None

    def dump(state):
        return None if state is None else json.dumps(state, sort_keys=True)

    def ends(batches):
        """(chunk, state before, state after) of each chunk; the state passes from chunk to chunk within a run."""
        rows, run, at, state, start = [], None, None, None, None
        for _, _, _, key, begun, piece in _pieces(batches, [*keys, RUN, CHUNK], used):
            if at is not None and key != at:
                rows.append((*at[:-2], at[-1], start, dump(state)))
                start = dump(state)
            if key[:-1] != run:
                run, state, start = key[:-1], load(begun), begun if isinstance(begun, str) else None
            at = key
            _, state = step(piece, state)
            if len(rows) >= 10_000:
                yield pd.DataFrame(rows, columns=[*by_chunk, "_start", "_end"])
                rows = []
        if at is not None:
            rows.append((*at[:-2], at[-1], start, dump(state)))
        yield pd.DataFrame(rows, columns=[*by_chunk, "_start", "_end"])

    def emit(batches):
        current, state, values, batch = None, None, [], None
        for pdf, _, _, key, begun, piece in _pieces(batches, by_chunk, used):
            if batch is not None and pdf is not batch:
                yield batch.drop(columns=["_start"]).assign(**{out: values})
                values = []
            batch = pdf
            if key != current:
                current, state = key, load(begun)
            results, state = step(piece, state)
            values.extend(results)
        if batch is not None:
            yield batch.drop(columns=["_start"]).assign(**{out: values})

    def fields(frame: DataFrame) -> str:
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)

    narrow = source.select(*dict.fromkeys([*keys, CHUNK, *order, *columns]))
    narrow = cut_lineage(spread(narrow, *by_chunk).sortWithinPartitions(*by_chunk, *order))
    end_schema = fields(narrow.select(*by_chunk)) + ", _start string, _end string"
    alone = narrow.withColumn(RUN, F.col(CHUNK)).withColumn("_start", F.lit(None).cast("string"))
    state = cut_lineage(alone.mapInPandas(ends, end_schema))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(CHUNK))
    handed = F.lag("_end").over(Window.partitionBy(*keys).orderBy(CHUNK))
    span = SPAN
    while True:
        wanted = state.withColumn("_want", handed).withColumn(RUN, F.floor(number / span).cast("long")).withColumn("_stale", ~F.col("_want").eqNullSafe(F.col("_start")))
        within = Window.partitionBy(*keys, RUN).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, 0)
        first = F.first(F.when(F.col("_stale"), F.struct(F.col("_want").alias("state"))), ignorenulls=True).over(within)
        again = cut_lineage(wanted.withColumn("_from", first).where(F.col("_from").isNotNull()).select(*by_chunk, RUN, F.col("_from.state").alias("_start")))
        if again.isEmpty():
            break
        rows = spread(narrow.join(again, by_chunk), *keys, RUN).sortWithinPartitions(*keys, RUN, CHUNK, *order)
        state = cut_lineage(state.join(again.select(*by_chunk), by_chunk, "left_anti").unionByName(rows.mapInPandas(ends, end_schema)))
        span *= SPAN

    started = spread(narrow.join(state.select(*by_chunk, "_start"), by_chunk), *by_chunk).sortWithinPartitions(*by_chunk, *order)
    return started.mapInPandas(emit, f"{fields(started.drop('_start'))}, {out} {out_type}").drop(CHUNK)
