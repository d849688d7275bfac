"""Quality rules from a suffix array over the words of each text.

Repeats are found by sorting the suffixes of every text's word sequence. Neighbours in that order share the longest
common prefixes; the intervals of those prefixes are the maximal repeated word strings, so the longest prefix shared
with either neighbour is, at each word, the length of the longest string that starts there and occurs again. Spans of
at least `min_repeat` words are united; a text fails if they cover too large a share of it or one of them is too long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

SPACE = common.byte_set([0x20, *range(0x09, 0x0E)])
SYMBOLS = common.byte_set(b"#*$%&|<>")

SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("covered_words", pa.int64()), ("longest_repeat", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "covered_words long, longest_repeat long, spans array<struct<start: long, end: long>>"
)


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of `words` (numbers 0..n-1) by prefix doubling, and for each k the class of every window of 2^k words.

    A rank is the number of suffixes before the suffix's group; only groups of more than one member are sorted again.
    """
    n = len(words)
    counts = np.bincount(words)
    rank = (np.cumsum(counts) - counts)[words].astype(np.int64)
    classes = [rank.astype(np.int32)]
    active = np.flatnonzero(counts[words] > 1)
    width = 1
    while len(active):
        ahead = active + width
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        order = np.argsort(key)
        active, key = active[order], key[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(fresh) - 1
        starts = np.flatnonzero(fresh)
        old = rank[active]
        first_of_old = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        base = np.repeat(first_of_old, np.diff(np.append(first_of_old, len(active))))
        rank[active] = old + starts[group] - base
        sizes = np.diff(np.append(starts, len(active)))
        active = active[sizes[group] > 1]
        classes.append(rank.astype(np.int32))
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, classes


def common_prefixes(order: np.ndarray, classes: list[np.ndarray]) -> np.ndarray:
    """Entry r: the number of words that suffix r shares with suffix r - 1 of the order (0 for the first)."""
    n = len(order)
    shared = np.zeros(n, np.int64)
    rows = 1 + np.flatnonzero(classes[0][order[1:]] == classes[0][order[:-1]]) if n > 1 else np.zeros(0, np.int64)
    a, b, got = order[rows - 1], order[rows], np.zeros(len(rows), np.int64)
    for k in range(len(classes) - 1, -1, -1):
        width, cls = 1 << k, classes[k]
        x, y = a + got, b + got
        fits = np.maximum(x, y) + width <= n
        same = fits & (cls[np.minimum(x, n - 1)] == cls[np.minimum(y, n - 1)])
        got += width * same
    shared[rows] = got
    return shared


def repeat_lengths(words: np.ndarray) -> np.ndarray:
    """At each word, the length of the longest string that starts there and occurs at another place too."""
    if not len(words):
        return np.zeros(0, np.int64)
    order, classes = suffix_order(words)
    shared = common_prefixes(order, classes)
    lengths = np.empty(len(words), np.int64)
    lengths[order] = np.maximum(shared, np.append(shared[1:], 0))
    return lengths


def union(lengths: np.ndarray, at_least: int, exactly: int | None = None) -> np.ndarray:
    """Flags of words within a span [i, i + lengths[i]) (or `exactly` words) of those with lengths[i] >= at_least."""
    at = np.flatnonzero(lengths >= at_least)
    edges = np.zeros(len(lengths) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + (lengths[at] if exactly is None else exactly), -1)
    return np.cumsum(edges[:-1]) > 0


def numbered(words: list[bytes]) -> tuple[list[int], int]:
    seen: dict[bytes, int] = {}
    number = seen.setdefault
    return [number(w, len(seen)) for w in words], len(seen)


def measure(rows: pa.RecordBatch, min_repeat: int, max_covered: float, max_repeat: int) -> pa.RecordBatch:
    """All columns of SCHEMA for the rows of one batch; the suffixes of all of its texts are sorted together.

    Words of different texts get different numbers, so no repeat reaches from one text into another.
    """
    data, offsets = common.rebased(*common.utf8(rows.column("text")))
    inside = ~SPACE[data]
    n_words = common.per_row(common.word_starts(inside, offsets), offsets)
    chars = common.per_row(inside & ((data & 0xC0) != 0x80), offsets)
    symbols = common.per_row(SYMBOLS[data], offsets)
    raw, dup_lines, numbers, used = data.tobytes(), [], [], 0
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        text = raw[start:end]
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        dup_lines.append(len(lines) - len(set(lines)))
        own, distinct = numbered(text.split())
        numbers.append(np.array(own, np.int64) + used)
        used += distinct
    bounds = np.concatenate([[0], np.cumsum(n_words)])
    lengths = repeat_lengths(np.concatenate(numbers))
    repeated = common.per_row(union(lengths, 3, 3), bounds)
    within = union(lengths, min_repeat)
    covered = common.per_row(within, bounds)
    longest = np.zeros(len(n_words), np.int64)
    filled = n_words > 0
    if filled.any():
        longest[filled] = np.maximum.reduceat(lengths, bounds[:-1][filled])
    failed = (n_words < 50) | (100 * repeated > 50 * n_words)
    kept = ~failed & (covered <= max_covered * n_words) & (longest <= max_repeat)
    edge = np.diff(np.concatenate([[0], within.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # a span that runs over the end of a text into the next one's is cut there
    cuts = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(within))]
    cuts = np.unique(cuts[within[cuts] & within[cuts - 1]]) if len(cuts) else cuts
    first, last = np.sort(np.append(first, cuts)), np.sort(np.append(last, cuts))
    row = np.searchsorted(bounds, first, side="right") - 1
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n_words)))]), pa.int32()),
        pa.StructArray.from_arrays([pa.array(first - bounds[row], pa.int64()), pa.array(last - bounds[row], pa.int64())], ["start", "end"]))
    return common.batch(SCHEMA, rows.column("doc_id"), n_words, chars, symbols, pa.array(dup_lines, pa.int64()), repeated, failed, kept, covered, longest, spans.cast(SCHEMA.field("spans").type))


def kept_rows(docs: DataFrame, text_col: str = "text", min_repeat: int = 8, max_covered: float = 0.5, max_repeat: int = 120) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns; see `repetition_quality`. Null and empty texts go."""
    at = docs.columns.index(text_col)
    names = [f"c{k}" for k in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.pieces(batches, names[at]):
            text = rows.column(names[at])
            measured = measure(pa.RecordBatch.from_arrays([pa.nulls(len(text), pa.int64()), text], names=["doc_id", "text"]), min_repeat, max_covered, max_repeat)
            yield rows.filter(measured.column("kept"))

    renamed = docs.toDF(*names)
    return renamed.mapInArrow(run, renamed.schema).toDF(*docs.columns)


def repetition_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = 8, max_covered: float = 0.5, max_repeat: int = 120) -> DataFrame:
    """One row per row of `docs`: word and line counts, the united repeated spans (in words), and whether to keep it.

    Nothing is shuffled; texts are measured where they are read, a few megabytes at a time, each whole. A null text
    counts as empty; empty texts have no words and fail. Repeated rows are measured again and agree; a null id stays
    null; an empty table gives an empty result; other columns of `docs`, whatever their names, are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.pieces(batches):
            yield measure(rows, min_repeat, max_covered, max_repeat)

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, DDL)
