"""Byte-level BPE over a corpus by a global shuffle of distinct words, and decoding by a table of token bytes.

1. Texts are split into words where they are read. Texts of an input split form blocks; a block numbers its distinct
   words, and a text becomes the row of its words' numbers by position.
2. Every block sends its distinct words, grouped by a hash, to the tasks of that hash. There each distinct word of the
   corpus is encoded once, and its ids go back to the blocks that asked.
3. A block's ids meet its texts' numbers, and every text is put together again by position.

Words and numbers travel compressed, one row per block and hash or per text: a row per word of the corpus would be many
times the input. Blocks are numbered by input split and order, so a task that runs again makes the same blocks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

BLOCK_BYTES = 24 << 20
GROUP_BYTES = 32 << 20  # of text whose words share one hash group; so groups grow in number, not in size

WORDS = pa.schema([("group", pa.int32()), ("block", pa.int64()), ("words", pa.binary())])
TEXTS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("numbers", pa.binary())])
IDS = pa.schema([("block", pa.int64()), ("group", pa.int32()), ("ids", pa.binary())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
RESULT_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_strings(words: list[str]) -> bytes:
    raw = [w.encode() for w in words]
    return packed(np.array([len(raw), *map(len, raw)], "<u4").tobytes() + b"".join(raw))


def unpack_strings(data: bytes) -> list[str]:
    data = unpacked(data)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 4)).tolist()
    text = data[4 + 4 * n :]
    return [text[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int | None], list[list[int]], list[str]]]:
    """(block, ids of its texts, the word numbers of each text, the distinct words) of each block of a split."""
    block = TaskContext.get().partitionId() << 32
    known: dict[str, int] = {}
    doc_ids, numbers, size = [], [], 0
    for rows in common.pieces(batches):
        for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True):
            split = tokens.words(text) if text else []
            number = known.setdefault
            doc_ids.append(doc_id)
            numbers.append([number(w, len(known)) for w in split])
            size += len(text or "")
        if size >= BLOCK_BYTES:
            yield block, doc_ids, numbers, list(known)
            block, known, doc_ids, numbers, size = block + 1, {}, [], [], 0
    if doc_ids:
        yield block, doc_ids, numbers, list(known)


def groups_of(words: list[str], groups: int) -> np.ndarray:
    return np.array([zlib.crc32(w.encode()) % groups for w in words], np.int64)


def send_words(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    for block, _, _, words in blocks(batches):
        order = np.argsort(groups_of(words, groups), kind="stable")
        bounds = np.searchsorted(groups_of(words, groups)[order], np.arange(groups + 1)).tolist()
        of_group = [[words[k] for k in order[a:b].tolist()] for a, b in zip(bounds, bounds[1:], strict=False)]
        filled = [g for g in range(groups) if of_group[g]]
        yield common.batch(WORDS, filled, [block] * len(filled), [pack_strings(of_group[g]) for g in filled])


def send_texts(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """The texts' rows of numbers, where words are numbered by group and then by first occurrence, as the ids come back."""
    for block, doc_ids, numbers, words in blocks(batches):
        place = np.empty(len(words), np.uint32)
        place[np.argsort(groups_of(words, groups), kind="stable")] = np.arange(len(words), dtype=np.uint32)
        yield common.batch(TEXTS, [block] * len(doc_ids), doc_ids, [packed(place[np.array(n, np.int64)].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()) for n in numbers])


def encode_group(path: str, rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of one hash group from all blocks: each distinct one is encoded once, each block gets its ids."""
    encode, known = tokens.encoding(path).encode_ordinary, {}
    for batch in rows:
        for group, block, words in zip(batch.column("group").to_pylist(), batch.column("block").to_pylist(), batch.column("words").to_pylist(), strict=True):
            asked = unpack_strings(words)
            for w in asked:
                if w not in known:
                    known[w] = tokens.as_bytes(encode(w))
            ids = [known[w] for w in asked]
            counts = np.array([len(ids), *(len(i) // 4 for i in ids)], "<u4")
            yield common.batch(IDS, [block], [group], [packed(counts.tobytes() + b"".join(ids))])


class Assembler:
    """The ids of a block's words, and the texts made from them."""

    def __init__(self, path: str, rows: list[tuple[int, bytes]]):
        counts, ids = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
        for _, data in sorted(rows):
            values = np.frombuffer(unpacked(data), "<u4")
            counts.append(values[1 : 1 + values[0]])
            ids.append(values[1 + values[0] :])
        self.counts, self.ids = np.concatenate(counts).astype(np.int64), np.concatenate(ids)
        self.starts = np.cumsum(self.counts) - self.counts
        self.token_bytes = tokens.token_bytes(path)

    def text_ids(self, numbers: bytes) -> np.ndarray:
        words = np.frombuffer(unpacked(numbers), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
        counts = self.counts[words]
        at = np.repeat(self.starts[words] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return self.ids[at]

    def row(self, numbers: bytes) -> tuple[int, str, str]:
        ids = self.text_ids(numbers)
        decoded = b"".join(map(self.token_bytes.__getitem__, ids.tolist()))
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def encode_corpus(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", groups: int | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded bytes of every row.

    `vocabulary` is a rank file that every executor can open. The number of hash groups follows the bytes of the table.
    `docs` must be a table scan or otherwise give its rows in the same order when it is computed again. A word may be as
    long as a whole text without blanks.

    A null or empty text has no ids and the digests of nothing. Repeated rows are encoded each; a null id stays null; an
    empty table gives an empty result; other columns are not read.
    """
    rows = common.id_and_text(docs, id_col, text_col)
    if groups is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        groups = max(8, -(-size // GROUP_BYTES))
    words = rows.mapInArrow(lambda it: send_words(it, groups), "group int, block long, words binary")

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encode_group(vocabulary, rows)

    ids = words.groupBy("group").applyInArrow(encode, "block long, group int, ids binary")
    texts = rows.mapInArrow(lambda it: send_texts(it, groups), "block long, doc_id long, numbers binary")

    def assemble(ids: pa.Table, texts: pa.Table) -> pa.Table:
        block = Assembler(vocabulary, list(zip(ids.column("group").to_pylist(), ids.column("ids").to_pylist(), strict=True)))
        got = [block.row(n.as_py()) for n in texts.column("numbers")]
        return pa.table([texts.column("doc_id"), *(pa.array([g[k] for g in got], t) for k, t in enumerate(RESULT.types[1:]))], schema=RESULT)

    return ids.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(assemble, RESULT_DDL)
