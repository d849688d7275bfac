"""Language identification: a byte network labels every position of a text, and the document pools the probabilities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bytegru, common

UNKNOWN = "und"
TRAIN_WIDTH, WIDTH, ROWS = 64, 128, 2048  # bytes of a training window and of a labelled one; windows labelled at once

DDL = "doc_id long, lang_pred string, score double"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
LETTER_BYTES = common.byte_set([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])


class Model:
    """The languages and the network that tells them apart; without a language everything is unknown."""

    def __init__(self, languages: list[str], network: bytegru.Network | None):
        self.languages, self.network = languages, network

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The mean probabilities (rows x languages) over the letter bytes of each row; every byte of the row is read."""
        lengths = np.diff(offsets)
        count = -(-lengths // WIDTH)
        row = np.repeat(np.arange(len(lengths)), count)
        begin = offsets[:-1][row] + WIDTH * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
        size = np.minimum(WIDTH, offsets[1:][row] - begin)
        padded = np.append(data, np.zeros(WIDTH, np.uint8))
        sums = np.zeros((len(lengths), len(self.languages)))
        weights = np.zeros(len(lengths))
        order = np.argsort(-size, kind="stable")
        for k in range(0, len(order), ROWS):
            at = order[k : k + ROWS]
            steps = np.arange(size[at].max())
            windows = padded[begin[at][:, None] + steps]
            counts = (steps < size[at][:, None]) & LETTER_BYTES[windows]
            windows[steps >= size[at][:, None]] = 0x20
            p = bytegru.label_positions(self.network, windows)
            np.add.at(sums, row[at], np.einsum("tnl,nt->nl", p, counts.astype(p.dtype)))
            np.add.at(weights, row[at], counts.sum(axis=1))
        return sums / np.maximum(weights, 1)[:, None]


def windows_of(batches: Iterator[pa.RecordBatch], per_text: int) -> Iterator[pa.RecordBatch]:
    """Training windows: evenly placed over each text, in whole bytes."""
    for rows in common.pieces(batches):
        data, offsets = common.utf8(rows.column("text"))
        found: list[tuple[str, bytes]] = []
        for lang, start, end in zip(rows.column("lang").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            places = np.unique(np.linspace(start, max(start, end - TRAIN_WIDTH), per_text).astype(int))
            found += [(lang, data[p : min(p + TRAIN_WIDTH, end)].tobytes().ljust(TRAIN_WIDTH)) for p in places.tolist() if end > start]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([w for _, w in found], pa.binary())], names=["lang", "window"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts_per_language: int = 400, windows_per_text: int = 8) -> Model:
    """A model from at most `texts_per_language` texts of each language, those of the smallest hashed ids.

    The driver gets `windows_per_text` windows of TRAIN_WIDTH bytes from each of them and trains on those.
    """
    rows = labelled.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = rows.select("doc_id", "lang").withColumn("n", first).where(F.col("n") <= texts_per_language).select("doc_id").distinct()
    sample = rows.join(F.broadcast(chosen), "doc_id", "left_semi")  # bounded by the parameter
    got = sample.select("text", "lang").mapInArrow(lambda it: windows_of(it, windows_per_text), "lang string, window binary").orderBy("lang", "window").collect()
    languages = sorted({r.lang for r in got})
    if not languages:
        return Model([], None)
    windows = np.array([np.frombuffer(bytes(r.window), np.uint8) for r in got])
    return Model(languages, bytegru.train(windows, np.array([languages.index(r.lang) for r in got]), len(languages)))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred and score (the pooled probability) of every row; nothing is shuffled, whole texts are read.

    Texts that are null, empty or without a letter, and all texts if the model has no language, are `und` with score 0.
    Repeated rows agree; a null id stays null; an empty table gives an empty result; other columns are not read, but
    those named in `keep` are carried along.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.pieces(batches):
            texts = rows.column("text").to_pylist()
            lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
            if model.network is None:
                predicted, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            else:
                p = model.pooled(*common.rebased(*common.utf8(rows.column("text"))))
                best = p.argmax(axis=1)
                predicted = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
                score = np.where(lettered, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
            out = [rows.column("doc_id"), pa.array(predicted, pa.string()), pa.array(score.astype(np.float64))]
            yield pa.RecordBatch.from_arrays([*out, *(rows.column(c) for c in more)], names=[*SCHEMA.names, *more])

    selected = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *(F.col(f"`{c}`").alias(f"kept_{k}") for k, c in enumerate(keep)))
    more = [f"kept_{k}" for k in range(len(keep))]
    ddl = DDL + "".join(f", kept_{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(keep))
    return selected.mapInArrow(run, ddl)


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n
