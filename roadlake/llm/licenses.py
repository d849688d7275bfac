"""License scan by ordered signature rules.

Every rule is a regular expression over the lower-cased words of a text, a label, a confidence and a priority. One
Aho-Corasick pass over the text finds the keywords in it, and a rule runs only if its keyword is there. Overlapping
detections are settled by interval containment: a detection inside another of the same or a higher priority goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

# The phrases that count as base places, and their labels.
BASE_PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}

# Families of licenses: label, names as word sequences, the version numbers that a name may carry, and aliases in file headers.
FAMILIES = [
    ("mit", ["mit", "expat"], [], ["mit"]),
    ("apache", ["apache", "apache software"], ["1 0", "1 1", "2 0", "2"], ["apache 2 0", "apache 1 1"]),
    ("bsd", ["bsd", "berkeley software distribution"], ["0 clause", "2 clause", "3 clause", "4 clause"], ["bsd 2 clause", "bsd 3 clause", "0bsd"]),
    ("gpl", ["gnu general public", "gnu gpl", "gpl"], ["1 0", "2", "2 0", "3", "3 0"], ["gpl 2 0", "gpl 3 0", "gplv2", "gplv3"]),
    ("lgpl", ["gnu lesser general public", "gnu library general public", "lgpl"], ["2 0", "2 1", "3", "3 0"], ["lgpl 2 1", "lgpl 3 0", "lgplv3"]),
    ("agpl", ["gnu affero general public", "affero general public", "agpl"], ["1 0", "3", "3 0"], ["agpl 3 0", "agplv3"]),
    ("mpl", ["mozilla public", "mpl"], ["1 0", "1 1", "2 0"], ["mpl 1 1", "mpl 2 0"]),
    ("epl", ["eclipse public", "epl"], ["1 0", "2 0"], ["epl 1 0", "epl 2 0"]),
    ("eupl", ["european union public", "eupl"], ["1 1", "1 2"], ["eupl 1 2"]),
    ("cddl", ["common development and distribution", "cddl"], ["1 0", "1 1"], ["cddl 1 0"]),
    ("cpl", ["common public"], ["1 0"], ["cpl 1 0"]),
    ("artistic", ["artistic", "perl artistic"], ["1 0", "2 0"], ["artistic 2 0"]),
    ("isc", ["isc", "internet systems consortium"], [], ["isc"]),
    ("zlib", ["zlib", "zlib libpng"], [], ["zlib"]),
    ("boost", ["boost software", "bsl"], ["1 0"], ["bsl 1 0"]),
    ("unlicense", ["unlicense"], [], ["unlicense"]),
    ("wtfpl", ["wtfpl", "do what the fuck you want to public"], ["2"], ["wtfpl"]),
    ("cc0", ["cc0", "cc zero", "creative commons zero"], ["1 0"], ["cc0 1 0"]),
    ("cc-by", ["cc by", "creative commons attribution"], ["2 0", "2 5", "3 0", "4 0"], ["cc by 3 0", "cc by 4 0"]),
    ("cc-by-sa", ["cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"], ["2 0", "2 5", "3 0", "4 0"], ["cc by sa 3 0", "cc by sa 4 0"]),
    ("cc-by-nc", ["cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"], ["2 0", "3 0", "4 0"], ["cc by nc 4 0"]),
    ("cc-by-nd", ["cc by nd", "creative commons attribution noderivatives", "creative commons attribution no derivatives"], ["2 0", "3 0", "4 0"], ["cc by nd 4 0"]),
    ("gfdl", ["gnu free documentation", "gfdl"], ["1 1", "1 2", "1 3"], ["gfdl 1 3"]),
    ("odbl", ["open database", "odbl"], ["1 0"], ["odbl 1 0"]),
    ("ogl", ["open government"], ["1 0", "2 0", "3 0"], ["ogl uk 3 0"]),
    ("ofl", ["sil open font", "open font"], ["1 0", "1 1"], ["ofl 1 1"]),
    ("psf", ["python software foundation", "psf"], ["2", "2 0"], ["psf 2 0"]),
    ("ms-pl", ["microsoft public", "ms pl"], [], ["ms pl"]),
    ("openssl", ["openssl"], [], ["openssl"]),
    ("vim", ["vim"], [], ["vim"]),
    ("php", ["php"], ["3 0", "3 01"], ["php 3 01"]),
    ("postgresql", ["postgresql"], [], ["postgresql"]),
]

# Statements that name no family: label, the words, the confidence.
STATEMENTS = [
    ("reserved", "all rights reserved", 0.6), ("reserved", "no part of this publication may be reproduced", 0.9), ("reserved", "unauthorized (?:copying|reproduction|use) is (?:strictly )?prohibited", 0.8),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d", 0.5), ("copyright", r"© (?:19|20)\d\d", 0.5), ("public-domain", "(?:placed|released|dedicated) (?:in|into|to) the public domain", 0.9), ("public-domain", "this (?:work|file|text) is in the public domain", 0.9),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 1.0), ("mit", "the software is provided as is without warranty of any kind", 0.6), ("bsd", "redistribution and use in source and binary forms", 0.9),
    ("bsd", "neither the name of the [^ ]+(?: [^ ]+){0,8} nor the names of its contributors", 1.0), ("isc", "permission to use copy modify and or distribute this software for any purpose", 0.9),
    ("gpl", "this program is free software you can redistribute it and or modify it", 0.9), ("gpl", "general public license", 0.6), ("lgpl", "this library is free software you can redistribute it and or modify it", 0.9),
    ("apache", "unless required by applicable law or agreed to in writing software", 0.8), ("mpl", "this source code form is subject to the terms of the mozilla public license", 1.0), ("unlicense", "this is free and unencumbered software released into the public domain", 1.0),
    ("zlib", "altered source versions must be plainly marked as such", 0.9), ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy", 0.9), ("wtfpl", "you just do what the fuck you want to", 1.0), ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", 0.8),
]


class Rule(NamedTuple):
    label: str
    pattern: re.Pattern[str]
    keyword: str
    confidence: float
    priority: int


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """The ordered rules: for every name of a family a bare form, one for each version, and how a text points to it.

    The order is the priority: file-header tags, then named versions, names, references and statements.
    """
    found: list[tuple[int, str, str, str, float]] = []
    for label, names, versions, tags in FAMILIES:
        for tag in tags:
            found.append((0, label, f"spdx license identifier {tag}", "identifier", 1.0))
        for name in names:
            key = max(name.split(), key=len)
            for version in versions:
                found.append((1, f"{label}-{version.replace(' ', '.')}" if "clause" not in version else f"{label}-{version.replace(' ', '-')}", rf"{name} (?:licen[cs]e )?(?:as published by the free software foundation )?(?:either )?(?:version |v)?{version}", key, 0.95))
            found.append((2, label, rf"{name} (?:public )?licen[cs]e", key, 0.8))
            found.append((2, label, rf"licen[cs]e {name}(?= |$)", key, 0.7))
            found.append((3, label, rf"(?:released|licensed|distributed|available|published) (?:under|with) (?:the |a |an )?(?:terms of (?:the )?)?{name}", key, 0.9))
    for label, words, confidence in STATEMENTS:
        plain = [w for w in re.findall("[a-z©]{2,}", re.sub(r"\([^)]*\)|\[[^]]*\]\+?", " ", words)) or ["©"]]
        found.append((4, label, words, "©" if words.startswith("©") else "proprietary" if label == "proprietary" else max(plain, key=len), confidence))
    return [Rule(label, re.compile(rf"(?<![^ ]){pattern}(?![^ ])"), keyword, confidence, 10_000 * (5 - kind) - at) for at, (kind, label, pattern, keyword, confidence) in enumerate(sorted(found, key=lambda x: x[0]))]


@lru_cache(maxsize=1)
def prefilter() -> ahocorasick.Automaton:
    """One automaton over all keywords; the value of a keyword is itself."""
    words = ahocorasick.Automaton()
    for keyword in {r.keyword for r in rules()} | {phrase[0] for phrase in BASE_PHRASES}:
        words.add_word(keyword, keyword)
    words.make_automaton()
    return words


LETTERS = common.byte_set([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LAST = {phrase[-1] for phrase in BASE_PHRASES}
DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<label: string, start: long, end: long, confidence: double>>"
)
DETECTION = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())])
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("detections", pa.list_(DETECTION)),
])


def settle(hits: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections in order of priority, without those inside a kept one; of equal spans the higher priority stays."""
    kept: list[tuple[int, int, Rule]] = []
    for start, end, rule in sorted(hits, key=lambda h: (-(h[2].priority // 10_000), h[0] - h[1], -h[2].priority, h[0])):
        if not any(a <= start and end <= b for a, b, _ in kept):
            kept.append((start, end, rule))
    return sorted(kept, key=lambda h: h[:2])


def scan(text: str) -> tuple[list[tuple[int, str]], list[dict]]:
    """The base places (first word, label) and the settled detections (spans in words) of a lower-cased text."""
    keywords = {k for _, k in prefilter().iter(text)}
    if not keywords:
        return [], []
    words = WORD.findall(text)
    base = [(i, label) for phrase, label in BASE_PHRASES.items() if phrase[0] in keywords for i, w in enumerate(words) if w == phrase[0] and tuple(words[i : i + len(phrase)]) == phrase]
    line = " ".join(words)
    hits = [(m.start(), m.end(), rule) for rule in rules() if rule.keyword in keywords for m in rule.pattern.finditer(line)]
    if not hits:
        return base, []
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])
    return base, [{"label": r.label, "start": int(np.searchsorted(starts, a, "right") - 1), "end": int(np.searchsorted(starts, b, "left")), "confidence": r.confidence} for a, b, r in settle(hits)]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: word count, base places and labels, the labels of all rules, their detections and a score.

    The score is 1 - prod(1 - confidence) over the labels' best detections, and 0 without any. Nothing is shuffled and
    the whole text is read. A null text counts as empty; texts without a place have null first_word and last_word and
    empty labels; repeated rows are scanned alike; an empty table gives an empty result; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.pieces(batches):
            data, offsets = common.rebased(*common.utf8(rows.column("text")))
            lowered = data.tobytes().translate(LOWER)
            n_words = common.per_row(common.word_starts(LETTERS[np.frombuffer(lowered, np.uint8)], offsets), offsets)
            out: list[list] = [[] for _ in range(7)]
            for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                base, found = scan(lowered[start:end].decode())
                best: dict[str, float] = {}
                for d in found:
                    best[d["label"]] = max(best.get(d["label"], 0.0), d["confidence"])
                names = {label for _, label in base}
                places = [i for i, _ in base]
                score = 1.0 - float(np.prod([1.0 - c for c in best.values()])) if best else 0.6 * bool(base)
                for column, value in zip(out, (len(base), min(places, default=None), max(places, default=None), ",".join(sorted(names)), ",".join(sorted(names | set(best))), score, found), strict=True):
                    column.append(value)
            yield common.batch(SCHEMA, rows.column("doc_id"), n_words, *out)

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, DDL)
