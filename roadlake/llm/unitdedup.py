"""Removal of repeated passages by hashing lines, paragraphs or sentences.

Texts are cut into units; a unit's normalised form is hashed to 128 bits. Over the whole corpus the earliest occurrence
of each digest is kept, by document id and place. A later occurrence goes if the run of later occurrences that it stands
in holds enough words, so that a short common phrase stays and a passage goes even where its units are sentences inside
longer lines. Spans of what is removed refer to the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Between units. Sentences also begin at a capital letter after a blank: a passage may be set into the midst of another sentence.
BREAKS = {
    "line": re.compile(r"[^\S\n]*\n\s*"),
    "paragraph": re.compile(r"[^\S\n]*\n[^\S\n]*\n\s*"),
    "sentence": re.compile(r"[^\S\n]*\n\s*|(?<=[.!?\"')])\s+|\s+(?=[A-ZÀ-ÖØ-ÞΑ-ΩА-Я¿¡])"),
}

SHORTEST = 4  # words of a unit that does not fill its line


def units(text: str, kind: str) -> list[tuple[int, int, int, bytes]]:
    """(start, end, words, digest) of each unit with a word; offsets in characters.

    Within a line, fewer than SHORTEST words make no unit: they go to the one before, or at its start to the one after.
    So a passage that is set into other text begins and ends with units of its own.
    """
    places: list[list[int]] = []  # start, end, words
    start, fresh = 0, True
    for at, following in [*(m.span() for m in BREAKS[kind].finditer(text)), (len(text), len(text))]:
        n = len(text[start:at].split())
        if n and not fresh and min(n, places[-1][2]) < SHORTEST:
            places[-1][1:] = [at, places[-1][2] + n]
        elif n:
            places.append([start, at, n])
        if n or "\n" in text[at:following]:
            fresh = "\n" in text[at:following]
        start = following
    return [(a, b, n, xxhash.xxh3_128_digest(" ".join(text[a:b].lower().split()))) for a, b, n in places]


def removed_spans(found: list[tuple[int, int, int, bytes]], later: set[int], min_words: int) -> list[tuple[int, int]]:
    """The spans of the runs of units numbered in `later` that hold at least `min_words` words."""
    spans, run, words = [], [], 0
    for k, (start, end, n, _) in enumerate([*found, (0, 0, 0, b"")]):
        if k in later:
            run.append((start, end))
            words += n
            continue
        if run and words >= min_words:
            spans.append((run[0][0], run[-1][1]))
        run, words = [], 0
    return spans


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; the white space after a span goes with it where there is some before it or nothing."""
    out, at = "", 0
    for start, end in spans:
        out += text[at:start]
        at = end
        if not out or out[-1].isspace():
            at += len(text) - end - len(text[end:].lstrip())
    return out + text[at:]


UNITS = "doc_id long, row long, unit int, high long, low long"
REPORT = "n_units: int, n_removed: int, removed_chars: long, spans: array<struct<start: int, end: int>>"


def digests(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    for rows in common.pieces(batches):
        found = [units(t, kind) if t else [] for t in rows.column("text").to_pylist()]
        counts = np.array([len(u) for u in found])
        at = pa.array(np.repeat(np.arange(len(found)), counts))
        hashes = np.frombuffer(b"".join(u[3] for us in found for u in us), "<i8").reshape(-1, 2)
        number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(at), rows.column("row").take(at), pa.array(number, pa.int32()), pa.array(hashes[:, 0]), pa.array(hashes[:, 1])], names=["doc_id", "row", "unit", "high", "low"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", min_words: int = 12) -> DataFrame:
    """Every row of `docs` with all its columns, its text without repeated passages, and n_units, n_removed,
    removed_chars and spans (of the original text) as a column `repeats`.

    Of equal units the one of the smallest id, then of the earlier row and place, stays; rows without an id come last.
    Digests meet in an aggregation that is partial before its shuffle, so a line that is in a third of all documents
    arrives as one row per task, and only repeated digests are joined back. `docs` is read once and written with its
    row numbers; all steps read that table.

    A null text stays null and an empty one empty. Repeated rows are later occurrences of each other, so all but one lose
    their text. A text of any length is cut whole. An empty table gives an empty result. A column of `docs` that is
    called `repeats` is replaced.
    """
    names = [c for c in docs.columns if c != "repeats"]
    at = names.index(text_col)
    rows = common.numbered(docs.drop("repeats").toDF(*(f"c{k}" for k in range(len(names)))), "row")
    keyed = rows.select(F.col(f"c{names.index(id_col)}").cast("long").alias("doc_id"), "row", F.col(f"c{at}").alias("text"))
    found = keyed.mapInArrow(lambda it: digests(it, unit), UNITS)
    place = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "row", "unit")
    first = found.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("high", "low", F.col("first.row").alias("first_row"), F.col("first.unit").alias("first_unit"))
    first = common.written(first)
    later = found.join(first, ["high", "low"]).where((F.col("row") != F.col("first_row")) | (F.col("unit") != F.col("first_unit"))).groupBy("row").agg(F.collect_list("unit").alias("later"))
    joined = rows.join(later, "row", "left")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.pieces(batches, f"c{at}"):
            texts, report = [], []
            for text, numbers in zip(batch.column(f"c{at}").to_pylist(), batch.column("later").to_pylist(), strict=True):
                all_units = units(text, unit) if text else []
                spans = removed_spans(all_units, set(numbers), min_words) if numbers else []
                inside = np.searchsorted([a for a, _ in spans], [s for s, _, _, _ in all_units], "right") - np.searchsorted([b for _, b in spans], [s for s, _, _, _ in all_units], "right")
                texts.append(without(text, spans) if spans else text)
                report.append({"n_units": len(all_units), "n_removed": int(inside.sum()), "removed_chars": sum(b - a for a, b in spans), "spans": [{"start": a, "end": b} for a, b in spans]})
            columns = [pa.array(texts, pa.string()) if k == at else batch.column(f"c{k}") for k in range(len(names))]
            kind = pa.struct([("n_units", pa.int32()), ("n_removed", pa.int32()), ("removed_chars", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
            yield pa.RecordBatch.from_arrays([*columns, pa.array(report, kind)], names=[*(f"c{k}" for k in range(len(names))), "report"])

    ddl = ", ".join(f"c{k} {docs.schema[n].dataType.simpleString()}" for k, n in enumerate(names))
    out = joined.select(*(f"c{k}" for k in range(len(names))), "later").mapInArrow(clean, f"{ddl}, report struct<{REPORT}>")
    return out.select(*(F.col(f"c{k}").alias(n) for k, n in enumerate(names)), F.col("report").alias("repeats"))
