"""Removal of lines that many documents share, by key digests dealt out by range; what stays is a bitmap per document.

1. Every document gives one row for each distinct key of its lines: the key's 128-bit digest and the lines that hold it.
2. The rows are range-partitioned by digest, document and line, and sorted so within partitions. Since the document is part
   of the range, a line that is in a third of all documents spreads over many partitions.
3. Each partition streams through its sorted rows. A run of equal digests is settled as soon as it is long enough; a task
   holds fewer rows of a run than the rule asks for. Only the first and last run of a partition may go on next door: their
   lengths meet in an aggregation of two rows a partition.
4. Lines that go come together per document as a compressed bitmap, so no text is shuffled before the last step.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KEYS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("first", pa.int32()), ("more", pa.binary())])
KEYS_DDL = "row long, doc_id long, high long, low long, first int, more binary"
MARKS = pa.schema([*KEYS, ("stays", pa.bool_()), ("n", pa.int64())])
MARKS_DDL = "row long, doc_id long, high long, low long, first int, more binary, stays boolean, n long"


def line_keys(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """One row per text and distinct key: its first line and, as 32-bit numbers, its further ones. bytes.strip and
    bytes.lower change exactly the ASCII white space and letters that a key is to be free of."""
    for rows in common.pieces(batches):
        data, offsets = common.utf8(rows.column("text"))
        at, digests, first, more = [], [], [], []
        for k in range(rows.num_rows):
            places: dict[bytes, list[int]] = {}
            for number, line in enumerate(data[offsets[k] : offsets[k + 1]].tobytes().split(b"\n")):
                key = line.strip().lower()
                if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                    places.setdefault(xxhash.xxh3_128_digest(key), []).append(number)
            at += [k] * len(places)
            digests += places
            first += [p[0] for p in places.values()]
            more += [np.array(p[1:], "<i4").tobytes() if len(p) > 1 else None for p in places.values()]
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        at = pa.array(at, pa.int64())
        yield common.batch(KEYS, rows.column("row").take(at), rows.column("doc_id").take(at), pa.array(halves[:, 0]), pa.array(halves[:, 1]), first, more)


class Runs:
    """Settles runs of equal keys, the rows of one partition given in order.

    Rows for lines that go come without a key; `stays` marks the one whose first line stays. Of a run at an edge of the
    partition, rows that cannot be settled here come with their key and n = 0, and one row gives its first document and n."""

    def __init__(self, min_documents: int, keep_first: bool):
        self.least, self.keep_first = min_documents, keep_first
        self.key, self.head, self.count, self.held, self.at_start = None, None, 0, [], True

    def rows(self, members: pa.RecordBatch, stays: bool, settled: bool) -> pa.RecordBatch:
        n = members.num_rows
        columns = {name: members.column(name) for name in KEYS.names}
        if settled:
            columns |= {"high": pa.nulls(n, pa.int64()), "low": pa.nulls(n, pa.int64())}
        return common.batch(MARKS, *columns.values(), [stays] * n, [None if settled else 0] * n)

    def take(self, members: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """More rows of the current run."""
        if not self.count:
            self.head = (members.column("row")[0].as_py(), members.column("doc_id")[0].as_py())
        held = sum(m.num_rows for m in self.held)
        fresh, whole, self.held = [*self.held, members], held == self.count, []
        self.count += members.num_rows
        if self.count < self.least:
            self.held = fresh
            return
        if self.keep_first and whole:  # none of the run has been given out yet
            yield self.rows(fresh[0].slice(0, 1), True, not self.at_start)
            fresh[0] = fresh[0].slice(1)
        for part in fresh:
            if part.num_rows:
                yield self.rows(part, False, True)

    def close(self, at_end: bool = False) -> Iterator[pa.RecordBatch]:
        """The current run ends here, or may go on in the next partition."""
        if self.key is None:
            return
        if self.at_start or at_end:
            for part in self.held:
                yield self.rows(part, False, False)
            yield common.batch(MARKS, *([v] for v in (*self.head, *self.key, None, None, False, self.count)))
        self.at_start, self.count, self.held = False, 0, []


def settle(batches: Iterator[pa.RecordBatch], min_documents: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    runs = Runs(min_documents, keep_first)
    for rows in batches:
        if not rows.num_rows:
            continue
        high, low = rows.column("high").to_numpy(), rows.column("low").to_numpy()
        starts = np.concatenate([[0], 1 + np.flatnonzero((high[1:] != high[:-1]) | (low[1:] != low[:-1]))])
        ends = np.append(starts[1:], len(high))
        # Short runs inside the batch and the partition are of no account; the others are gone through one by one.
        matter = (ends - starts >= min_documents) | (starts == 0) | (ends == len(high))
        if not keep_first or min_documents > 1:
            pick = np.flatnonzero(matter)
        else:
            repeated = np.concatenate([[0], np.cumsum(~np.asarray(rows.column("more").is_null()))])
            pick = np.flatnonzero((ends - starts > 1) | (repeated[ends] > repeated[starts]) | (starts == 0) | (ends == len(high)))
        for k in pick.tolist():
            key = (int(high[starts[k]]), int(low[starts[k]]))
            if key != runs.key:
                yield from runs.close()
                runs.key = key
            yield from runs.take(rows.slice(int(starts[k]), int(ends[k] - starts[k])))
    yield from runs.close(at_end=True)


def packed_bits(lines: np.ndarray) -> bytes:
    """Bits of the lines up to the last that goes, 1 for a line that stays; the lines after them stay."""
    keep = np.ones(-(-(int(lines.max()) + 1) // 8) * 8 if len(lines) else 0, bool)
    keep[lines] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def kept_flags(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    keep = np.ones(n_lines, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
        keep[: len(bits)] = bits
    return keep


def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        dropped, maps = [], []
        for marks in rows.column("marks").to_pylist():
            parts = [np.array([m["first"] for m in marks if not m["stays"]], "<i4"), *(np.frombuffer(m["more"], "<i4") for m in marks if m["more"])]
            lines = np.concatenate(parts)
            dropped.append(len(lines))
            maps.append(packed_bits(lines))
        yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())], names=["row", "n_dropped", "keep"])


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_documents: int = 1, min_chars: int = 1, keep_first: bool = True) -> DataFrame:
    """doc_id, text, n_lines, n_dropped and keep of every row: a zlib-compressed bitmap of the lines that stay, first line in
    the highest bit; null where all stay.

    Lines are split at newlines; a line's key is the line without ASCII white space at its ends, A to Z in lower case. Keys
    of at least `min_chars` code points that at least `min_documents` rows hold lose all their lines, but for the first line
    of the earliest row (by id, then by place in the table; rows without an id last) if `keep_first`. So by default every
    later occurrence of a line goes, in other documents and in its own.

    A null or empty text is one empty line, which has no key and stays. Each row is a document of its own, so repeated
    rows count each, and equal ids are told apart by their place. Texts of any length are split whole. An empty table gives
    an empty result. Other columns are not read.
    """
    rows = common.numbered(common.id_and_text(docs, id_col, text_col), "row")
    keys = rows.mapInArrow(lambda it: line_keys(it, min_chars), KEYS_DDL)
    order = ["high", "low", F.col("doc_id").isNull(), "doc_id", "row"]
    dealt = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = common.written(dealt.mapInArrow(lambda it: settle(it, min_documents, keep_first), MARKS_DDL))
    edge = marked.where("high IS NOT NULL")
    place = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "row")
    totals = edge.where("n > 0").groupBy("high", "low").agg(F.sum("n").alias("total"), F.min(place)["row"].alias("earliest")).where(F.col("total") >= min_documents)
    stays = (F.col("row") == F.col("earliest")) if keep_first else F.lit(False)
    settled = edge.where("n = 0").join(totals, ["high", "low"]).select("row", "first", "more", stays.alias("stays"))
    gone = marked.where("high IS NULL").select("row", "first", "more", "stays").unionByName(settled).where("NOT stays OR more IS NOT NULL")
    maps = gone.groupBy("row").agg(F.collect_list(F.struct("first", "more", "stays")).alias("marks")).mapInArrow(bitmaps, "row long, n_dropped long, keep binary")
    n_lines = F.coalesce(F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))), F.lit(0)) + 1
    return rows.join(maps, "row", "left").select("doc_id", "text", n_lines.cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep")


def kept_text(found: DataFrame) -> DataFrame:
    """The rows of `line_bitmaps` with `text` made of the lines that stay, joined by newlines; null texts stay null."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.pieces(batches):
            texts = []
            for text, keep in zip(rows.column("text").to_pylist(), rows.column("keep").to_pylist(), strict=True):
                if keep is not None:
                    lines = text.split("\n")
                    text = "\n".join([lines[k] for k in np.flatnonzero(kept_flags(keep, len(lines))).tolist()])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(texts, pa.string()), *rows.columns[2:]], names=rows.schema.names)

    return found.mapInArrow(clean, found.schema)
