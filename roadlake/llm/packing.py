"""Packing token sequences: order-preserving dynamic programming over cut places.

The documents of an input split, in their order, form one stream of ids. A cut may stand at the end of a document, of
a sentence, or, at a higher price, at any of the places of a grid. With f(j) the least cost of a stream that is cut at j,

    f(j) = price(j) + min over i in [j - window, j) of f(i) + padding(j - i),

where padding is window - (j - i), or nothing when j - i is a power of two. The minimum of f(i) + i over the sliding
range is the front of a monotone queue, so each cut place is pushed and popped once.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common, tokens

SENTENCE_PRICE, GRID_PRICE, GRID = 2, 24, 256

DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
SCHEMA = pa.schema([(part.split()[0], pa.int64()) for part in DDL.split(", ")])


def cut_places(sentence_end: np.ndarray, doc_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, prices): the ends of documents cost nothing, of sentences little, and of a grid's cells most."""
    n = len(sentence_end)
    price = np.full(n + 1, -1, np.int64)
    price[GRID::GRID] = GRID_PRICE
    price[1 + np.flatnonzero(sentence_end)] = SENTENCE_PRICE
    price[doc_ends] = 0
    price[n] = 0
    price[0] = -1
    places = np.flatnonzero(price >= 0)
    return places, price[places]


def best_cuts(places: np.ndarray, prices: np.ndarray, window: int) -> list[int]:
    """The places of a cheapest cutting into windows of at most `window` ids, last one first; `places` leave no wider gap."""
    at, cost = [0, *places.tolist()], [0, *prices.tolist()]
    index = {p: k for k, p in enumerate(at)}
    whole = [window >> k for k in (1, 2) if window & (window - 1) == 0 and window >> k]  # the unpadded lengths worth trying
    best, came = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # (f(i) + i, i's place, i's number), rising
    for k in range(1, len(at)):
        j = at[k]
        while queue[0][1] < j - window:
            queue.popleft()
        value, _, i = queue[0]
        least = value + window - j
        for width in whole:
            if (m := index.get(j - width)) is not None and best[m] < least:
                least, i = best[m], m
        best[k], came[k] = least + cost[k], i
        value = best[k] + j
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j, k))
    cuts, k = [], len(at) - 1
    while k:
        cuts.append(at[k])
        k = came[k]
    return cuts


def windows(sentence_end: np.ndarray, doc_ends: np.ndarray, window: int) -> np.ndarray:
    """The ends of all windows of a stream, rising. The tail that fills no window is cut into powers of two, unpadded."""
    n = len(sentence_end)
    ends = np.array(best_cuts(*cut_places(sentence_end, doc_ends), window)[::-1], np.int64)
    begin = int(ends[-2]) if len(ends) > 1 else 0
    rest, tail = n - begin, []
    for k in range(rest.bit_length() - 1, -1, -1):
        if rest >> k & 1:
            begin += 1 << k
            tail.append(begin)
    return np.append(ends[:-1], np.array(tail, np.int64))


def pack_block(doc_ids: list[int | None], ids: list[np.ndarray], ends_sentence: np.ndarray, window: int, first_sequence: int) -> pa.RecordBatch:
    """The pieces of one block of documents, in order."""
    stream = np.concatenate(ids)
    lengths = np.array([len(x) for x in ids], np.int64)
    doc_ends = np.cumsum(lengths)
    doc_starts = doc_ends - lengths
    cuts = windows(ends_sentence[stream], doc_ends, window)
    ends = np.union1d(cuts, doc_ends)
    starts = np.append(0, ends[:-1])
    doc, sequence = np.searchsorted(doc_ends, starts, side="right"), np.searchsorted(cuts, starts, side="right")
    from_window = np.append(0, cuts)[sequence]
    raw = memoryview(stream.astype("<u4").tobytes())
    sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return common.batch(
        SCHEMA, pa.array(doc_ids, pa.int64()).take(pa.array(doc)), starts - doc_starts[doc], ends - starts, pa.array(sums, pa.int64()), lengths[doc], first_sequence + sequence, starts - from_window,
        np.diff(np.append(0, cuts))[sequence])


def pack_sequences(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1, block_tokens: int = 1 << 20,
) -> DataFrame:
    """One row per piece of a document in a sequence; each id lies in exactly one piece, and pieces keep the order.

    Documents are packed where they are read, in blocks of about `block_tokens` ids, so that nothing is shuffled and a
    task holds one block. A sequence's number is its input split's number times 2^40 plus its place there, so a task that
    is run again gives the same numbers. `vocabulary` is a tokenizer file that every executor can open.

    A null or empty text is just `end_id`; a document longer than a window goes on in the next ones; repeated rows are
    packed each; a null id stays null; an empty table gives an empty result; other columns of `docs` are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends_sentence = tokens.encoding(vocabulary).encode_ordinary, tokens.sentence_ends(vocabulary)
        sequence, held_ids, held, size = TaskContext.get().partitionId() << 40, [], [], 0
        for rows in common.pieces(batches):
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), end_id], np.uint32)
                held_ids.append(doc_id)
                held.append(ids)
                size += len(ids)
                if size >= block_tokens:
                    out = pack_block(held_ids, held, ends_sentence, window, sequence)
                    sequence = out.column("sequence_id")[-1].as_py() + 1
                    yield out
                    held_ids, held, size = [], [], 0
        if held:
            yield pack_block(held_ids, held, ends_sentence, window, sequence)

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, DDL)
