"""Alignment of the tokens of two vocabularies over a corpus, by windows between white-space anchors.

1. Every text is encoded whole by both vocabularies. Its tokens' ends in bytes give the shared ends; a shared end after
   which both vocabularies go on with a token that begins with a space is an anchor. Anchors cut a text into windows of
   token ids, mostly a word each.
2. Texts of an input split form blocks. In a block each distinct window, a pair of id tuples, is aligned once: its groups,
   and the pairs of tokens whose bytes overlap. A text is then a row of window numbers. One job writes texts and, per
   block, windows and counts of distinct pairs; everything later reads that table.
3. Counts of pairs meet in an aggregation, as does the highest count of each B id. Every block gets the counts of its own
   pairs back, sums them over windows, and over the windows of its texts.

No row per token or link of a text is ever shuffled: what moves is distinct pairs per block and compressed numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens
from .bytepair import packed, unpacked

BLOCK_BYTES = 4 << 20
BLOCKS_A_TASK = 2

ALIGNED = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
    ("numbers", pa.binary()), ("windows", pa.binary()), ("pairs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("links", pa.int64())])))])
ALIGNED_DDL = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, numbers binary, windows binary, "
               "pairs array<struct<a: int, b: int, links: long>>")
RESULT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])
RESULT_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Vocabulary:
    """Ids of texts, and by id the bytes, their number, and whether they begin with a space."""

    def __init__(self, encode, token_bytes: list[bytes]):
        self.encode, self.bytes = encode, token_bytes
        self.lengths = np.array([len(t) for t in token_bytes], np.int64)
        self.spaced = np.array([t.startswith(b" ") for t in token_bytes])

    def gives(self, ids: list[int], raw: bytes) -> bool:
        """Whether the tokens' bytes are the text's."""
        return b"".join(map(self.bytes.__getitem__, ids)) == raw


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    """A byte-level vocabulary, for a space and the text."""
    encode = tokens.encoding(path).encode_to_numpy
    return Vocabulary(lambda text: encode(" " + text, disallowed_special=()).astype("<i4"), tokens.token_bytes(path))


@lru_cache(maxsize=2)
def pieces(path: str) -> Vocabulary:
    """A sentencepiece vocabulary, which puts the space before the text itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return Vocabulary(lambda text: model.encode([text], num_threads=1)[0], [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)])


class Aligner:
    """Aligns windows, many at a time: since both sides of a window end together, windows laid end to end stay apart."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.lengths = (a.lengths, b.lengths)
        # A token written out, and what follows it: another of its group, the group's other side, or the next group.
        self.written = [f"{i}{sign}" for n, signs in ((len(a.bytes), ",|"), (len(b.bytes), ",;")) for sign in signs for i in range(n)]
        self.first = np.cumsum([0, len(a.bytes), len(a.bytes), len(b.bytes)])
        self.size = np.array([len(w) for w in self.written], np.int64)

    def __call__(self, windows: list[tuple[bytes, bytes]]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Each window's groups written out, its number of links, and the pairs that the links of all of them join, in order, as
        one number each. A link is a stretch of bytes that no token's end divides, so it stands for one token on either side."""
        ids = [np.frombuffer(b"".join([w[k] for w in windows]), "<i4") for k in (0, 1)]
        counts = [np.array([len(w[k]) >> 2 for w in windows]) for k in (0, 1)]
        ends = [length[i].cumsum() for length, i in zip(self.lengths, ids, strict=True)]
        at = [np.zeros(int(ends[0][-1]) + 1, bool) for _ in ends]
        for flags, end in zip(at, ends, strict=True):
            flags[end] = True
        links, shared = np.flatnonzero(at[0] | at[1]), np.flatnonzero(at[0] & at[1])
        pairs = (ids[0][np.searchsorted(ends[0], links)].astype(np.int64) << 32) | ids[1][np.searchsorted(ends[1], links)]
        window_ends = ends[0][counts[0].cumsum() - 1]
        n_links = np.diff(np.searchsorted(links, window_ends, side="right"), prepend=0)
        last = [at[1][ends[0]], at[0][ends[1]]]
        order = np.argsort(np.concatenate([2 * np.searchsorted(shared, ends[0]), 2 * np.searchsorted(shared, ends[1]) + 1]), kind="stable")
        names = np.concatenate([ids[k] + self.first[2 * k + last[k].astype(np.int64)] for k in (0, 1)])[order]
        text = "".join([self.written[k] for k in names.tolist()])
        cuts = [0, *self.size[names].cumsum()[(counts[0] + counts[1]).cumsum() - 1].tolist()]
        return [text[i : j - 1] for i, j in zip(cuts, cuts[1:], strict=False)], n_links, pairs


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(byte_level(path_a), pieces(path_b))


class Windows(dict):
    """A window's number by its two id tuples, in the order in which they are first asked for; `fresh` has the latest."""

    def __init__(self):
        self.fresh: list[tuple[bytes, bytes]] = []

    def __missing__(self, window: tuple[bytes, bytes]) -> int:
        number = self[window] = len(self)
        self.fresh.append(window)
        return number


class Block:
    """The texts of a block and the windows seen in them, each aligned once."""

    def __init__(self, number: int, path_a: str, path_b: str):
        self.number, self.a, self.b, self.align = number, byte_level(path_a), pieces(path_b), aligner(path_a, path_b)
        self.known = Windows()
        self.shown: list[str] = []  # a window's groups, written out
        self.n_links, self.pairs, self.uses = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        self.rows: list[tuple] = []
        self.size = 0

    def numbers(self, text: str | None) -> tuple[int, int, int, list[int]]:
        """Tokens of either vocabulary, groups, and the windows in order; none of a text that has no tokens. The bytes of a
        byte-level vocabulary's tokens are always the text's, as far as their number is."""
        raw = b" " + text.encode() if text else b""
        self.size += len(raw)
        if not raw:
            return 0, 0, 0, []
        a, ids_b = self.a.encode(text), self.b.encode(text)
        ends_a = self.a.lengths[a].cumsum()
        if ends_a[-1] != len(raw) or not self.b.gives(ids_b, raw):
            return 0, 0, 0, []
        b = np.array(ids_b, "<i4")
        ends_b = self.b.lengths[b].cumsum()
        of_a, of_b = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 1, bool)
        of_a[ends_a] = of_b[ends_b] = True
        at_a, at_b = 1 + np.flatnonzero(of_b[ends_a]), 1 + np.flatnonzero(of_a[ends_b])  # the tokens after each shared end; the last is the text's end
        anchor = np.append(self.a.spaced[a[at_a[:-1]]] & self.b.spaced[b[at_b[:-1]]], True)
        cuts_a, cuts_b = [0, *(4 * at_a[anchor]).tolist()], [0, *(4 * at_b[anchor]).tolist()]
        bytes_a, bytes_b, known = a.tobytes(), b.tobytes(), self.known
        return len(a), len(b), len(at_a), [known[bytes_a[p:q], bytes_b[r:s]] for p, q, r, s in zip(cuts_a, cuts_a[1:], cuts_b, cuts_b[1:], strict=False)]

    def add(self, doc_ids: list[int | None], texts: list[str | None]) -> None:
        cut = [self.numbers(t) for t in texts]
        if self.known.fresh:
            shown, n_links, pairs = self.align(self.known.fresh)
            self.known.fresh = []
            self.shown += shown
            self.n_links.append(n_links)
            self.pairs.append(pairs)
        for doc_id, (n_a, n_b, n_groups, numbers) in zip(doc_ids, cut, strict=True):
            if not numbers:
                self.rows.append((doc_id, 0, 0, 0, 0, "", None))
                continue
            digest = hashlib.sha256(";".join([self.shown[k] for k in numbers]).encode()).hexdigest()
            used = np.array(numbers, np.uint32)
            self.uses.append(used)
            self.rows.append((doc_id, n_a, n_b, n_groups, n_a + n_b - n_groups, digest, packed(planes(used))))  # a link ends with one token or with two

    def table(self) -> pa.RecordBatch:
        """The rows of the texts, and one for the block: its windows as lists of pairs, and its pairs with their links."""
        per_window = np.concatenate(self.n_links)
        encoded = pa.array(np.concatenate(self.pairs)).dictionary_encode()
        distinct, numbers = encoded.dictionary.to_numpy(), encoded.indices.to_numpy()
        uses = np.bincount(np.concatenate([np.zeros(0, np.uint32), *self.uses]), minlength=len(per_window))
        links = np.bincount(numbers, np.repeat(uses, per_window), minlength=len(distinct)).astype(np.int64)
        windows = packed(np.concatenate([[len(per_window)], per_window, numbers]).astype("<u4").tobytes())
        structs = pa.StructArray.from_arrays([pa.array((distinct >> 32).astype(np.int32)), pa.array((distinct & 0xFFFFFFFF).astype(np.int32)), pa.array(links)], names=["a", "b", "links"])
        n = len(self.rows)
        of_pairs = pa.ListArray.from_arrays(pa.array([None] * n + [0, len(structs)], pa.int32()), structs)  # a null offset is a null list
        columns = list(zip(*self.rows, strict=True)) if n else [()] * 7
        return common.batch(ALIGNED, [self.number] * (n + 1), *([*c, None] for c in columns), [None] * n + [windows], of_pairs)


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, which compresses better."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def align_blocks(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    block = None
    for rows in common.pieces(batches, limit=1 << 20):
        block = block or Block(number, path_a, path_b)
        block.add(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist())
        if block and block.size >= BLOCK_BYTES:
            yield block.table()
            block, number = None, number + 1
    if block:
        yield block.table()


def gather(scored: pa.Table, rows: pa.Table) -> pa.Table:
    """The results of a block's texts from its windows and the corpus-wide counts of its pairs."""
    rows, of_block = rows.filter(rows.column("windows").is_null()), rows.filter(rows.column("windows").is_valid())
    layout = np.frombuffer(unpacked(of_block.column("windows")[0].as_py()), "<u4").astype(np.int64)
    n, at = int(layout[0]), layout[1 + int(layout[0]) :]
    ends = np.concatenate([[0], layout[1 : 1 + n].cumsum()])
    per_window = []
    for column in ("best", "total"):
        of_pair = np.zeros(scored.num_rows, np.int64)
        of_pair[scored.column("pair").to_numpy()] = scored.column(column).to_numpy()
        running = np.concatenate([[0], of_pair[at].cumsum()])
        per_window.append(running[ends[1:]] - running[ends[:-1]])
    sums = [[], []]
    for numbers in rows.column("numbers").to_pylist():
        used = from_planes(unpacked(numbers)) if numbers else np.zeros(0, np.uint32)
        for out, values in zip(sums, per_window, strict=True):
            out.append(int(values[used].sum()))
    return pa.table([*(rows.column(c) for c in RESULT.names[:5]), *(pa.array(s, pa.int64()) for s in sums), rows.column("groups_sha256")], schema=RESULT)


def align_corpus(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    `vocabulary_a` is a file of a byte-level vocabulary, applied to a space and the text, `vocabulary_b` a sentencepiece model,
    which adds the space; both are files that every executor can open. Special tokens' strings are plain text. A pair's
    count is the number of links of all texts that join its two ids. n_best counts the links whose count is the highest
    that their B id has (ties included), count_sum adds the counts up over links.

    Texts that are null, empty or that either vocabulary does not give back byte by byte have no tokens: zeros and an empty
    digest. Repeated rows count each; a null id stays null; a text of any length is encoded whole; an empty table gives an
    empty result. Other columns are not read.
    """
    rows = common.id_and_text(docs, id_col, text_col)
    aligned = common.written(rows.mapInArrow(lambda it: align_blocks(it, vocabulary_a, vocabulary_b), ALIGNED_DDL))
    blocks = aligned.where("pairs IS NOT NULL")
    tasks = max(1, -(-blocks.select("block").count() // BLOCKS_A_TASK))
    pairs = blocks.select("block", F.posexplode("pairs").alias("pair", "p")).select("block", "pair", "p.a", "p.b", "p.links")
    totals = pairs.groupBy("a", "b").agg(F.sum("links").alias("total"))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    scored = totals.join(highest, "b").select("a", "b", "total", (F.col("total") == F.col("highest")).cast("int").alias("best"))
    back = pairs.join(scored, ["a", "b"]).select(F.col("block").alias("of"), "pair", "total", "best").repartition(tasks, "of")
    texts = aligned.select(F.col("block").alias("holder"), *RESULT.names[:5], "groups_sha256", "numbers", "windows").repartition(tasks, "holder")
    return back.groupBy("of").cogroup(texts.groupBy("holder")).applyInArrow(gather, RESULT_DDL)
