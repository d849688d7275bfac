"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text and normalised by length.

Folding makes a skeleton of a text: lower case, look-alike letters of other scripts and digits or signs used as letters
replaced, and everything but letters turned into single blanks. The lexicon holds beginnings of words (a whole word is
a beginning too), each with the log odds of toxic against other labelled texts. A match does not count within an
exception phrase, a pair of a match and a neighbouring word that is found in texts labelled as not toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.session import cut_lineage

from . import common

# Letters of other scripts that look like a Latin one, then digits and signs used for letters.
# The digit 1 and its like stand for i here; terms with an l are also matched with an i in its place.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "г": "r", "п": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ѵ": "v", "ց": "g", "ո": "n", "օ": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e", "|": "i", "!": "i"}
FULL_WIDTH = {0xFF21 + k: 97 + k for k in range(26)} | {0xFF41 + k: 97 + k for k in range(26)}
INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
FOLD = FULL_WIDTH | INVISIBLE | str.maketrans(LOOKALIKES | DIGITS)
LATE_SIGNS = re.compile(r"[!@$|€]+(?!\w)")  # signs that no letter follows stand for none
NOT_LETTERS = re.compile(r"[^\w]+|_+")
HASH_BITS = 30
SHORTEST, LONGEST = 4, 12  # letters of a word's beginning in the lexicon


class Lexicon(NamedTuple):
    weights: dict[str, float]
    exceptions: frozenset[tuple[str, str]]
    bias: float
    slopes: tuple[float, float]


def folded(text: str) -> str:
    """The skeleton of a text, with a blank at either end."""
    return f" {NOT_LETTERS.sub(' ', LATE_SIGNS.sub(' ', text.lower()).translate(FOLD)).strip()} "


def automaton(weights: dict[str, float]) -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for term in sorted(weights, key=lambda t: "l" not in t):  # a term itself goes before another's variant
        words.add_word(" " + term.replace("l", "i"), term)
        words.add_word(" " + term, term)
    words.make_automaton()
    return words


def matches(skeleton: str, words: ahocorasick.Automaton) -> Iterator[tuple[str, str, str]]:
    """(term, word before, word after) of each match of a beginning; of several at one word only the longest."""
    last: tuple[int, int, str] | None = None
    found = []
    for end, term in words.iter(skeleton) if len(words) else ():
        start = end - len(term)  # at the blank
        if last and last[0] == start:
            found[-1] = (start, end, term)
        else:
            found.append((start, end, term))
        last = found[-1]
    for start, end, term in found:
        stop = skeleton.index(" ", end)
        before = skeleton[skeleton.rfind(" ", 0, start) + 1 : start] if start > 0 else ""
        after = skeleton[stop + 1 : skeleton.index(" ", stop + 1)] if stop + 1 < len(skeleton) else ""
        yield term, before, after


def measured(skeleton: str, words: ahocorasick.Automaton, lexicon: Lexicon) -> tuple[float, int]:
    """The sum of the weights of counted matches, and the number of words."""
    total = sum(lexicon.weights[t] for t, before, after in matches(skeleton, words) if (before, t) not in lexicon.exceptions and (t, after) not in lexicon.exceptions)
    return total, skeleton.count(" ") - 1


def features(total: float, n_words: int) -> tuple[float, float]:
    """Both grow with the matched weight: as it is, and normalised by the length."""
    return math.log1p(total), math.log1p(100 * total / max(n_words, 1))


def texts(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[list[tuple]]:
    for rows in common.pieces(batches):
        yield list(zip((t or "" for t in rows.column("text").to_pylist()), *(rows.column(c).to_pylist() for c in more), strict=True))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic texts, other texts) of the beginnings of words in each run of rows."""
    for rows in texts(batches, "toxic"):
        counts = (Counter(), Counter())
        for text, toxic in rows:
            found = set(folded(text).split())
            counts[toxic].update({w[:n] for w in found for n in range(min(len(w), SHORTEST), min(len(w), LONGEST) + 1)})
        terms = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())], names=["term", "toxic", "other"])


def _pairs(weights: dict[str, float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, second, toxic texts, other texts) of the pairs of a match and a neighbouring word."""
    words = automaton(weights)
    for rows in texts(batches, "toxic"):
        counts = (Counter(), Counter())
        for text, toxic in rows:
            counts[toxic].update({p for t, before, after in matches(folded(text), words) for p in ((before, t), (t, after)) if p[0] and p[1]})
        pairs = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)), pa.array([counts[1][p] for p in pairs], pa.int64()), pa.array([counts[0][p] for p in pairs], pa.int64())], names=["first", "second", "toxic", "other"])


def smallest_lexicon(found: Iterable[tuple[str, int, int]], n_toxic: int, n_other: int, odds: float) -> dict[str, float]:
    """Weights of terms, shortest first; a longer term stays only if its odds beat those of its own beginning clearly."""
    weights: dict[str, float] = {}
    for term, toxic, other in sorted(found, key=lambda r: (len(r[0]), r[0])):
        weight = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_other + 1))
        held = max((weights.get(term[:n], -9.0) for n in range(1, len(term))), default=-9.0)
        if weight >= odds and weight > held + 0.7:
            weights[term] = weight
    return weights


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients by Newton's method with a small ridge, intercept first; slopes are not let below zero."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta = beta - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - y)) + ridge @ beta)
    return np.array([beta[0], *np.maximum(beta[1:], 0)])


def alike(text: Column) -> Column:
    """A number that copies and most near copies share: the least hash of their sentences. Copies would count as support."""
    sentences = F.filter(F.split(text, r"[.!?\n]+\s*"), lambda x: F.length(x) >= 20)
    return F.coalesce(F.array_min(F.transform(sentences, lambda x: F.xxhash64(x))), F.xxhash64(text))


def hash_share(counts: dict[int, int], most: dict[int, int]) -> Column:
    """Whether a row's hashed id is among the smallest of its label, so many that about `most` of `counts` rows are."""
    share = {k: min(1 << HASH_BITS, (n << HASH_BITS) // max(1, counts.get(k, 0))) for k, n in most.items()}
    return F.xxhash64("doc_id").bitwiseAND((1 << HASH_BITS) - 1) < F.when(F.col("toxic") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))


def sampled(docs: DataFrame, labels: DataFrame, toxic_texts: int = 4000, other_texts: int = 16000) -> DataFrame:
    """(doc_id, text, toxic) of about `toxic_texts` toxic and `other_texts` other documents, those of the smallest hashed ids.

    They are chosen from `labels` (doc_id, toxic) alone, so texts are read but only the chosen ones move. A document labelled
    more than once is one row, toxic if any label says so; labels other than 0 and 1, null ids and ids without a document
    are left out; repeated documents are rows each."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = common.written(known.where(hash_share(counts, {1: toxic_texts, 0: other_texts})))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about as many ids as texts are asked for


def fit(labelled: DataFrame, toxic_texts: int = 4000, other_texts: int = 16000, odds: float = 2.5) -> Lexicon:
    """A lexicon from (doc_id, text, toxic): about `toxic_texts` and `other_texts` rows, those of the smallest hashed ids. The
    rows are chosen where they are read, by the share of the hashes that gives so many. Repeated ids are rows each.

    Terms need a dozen toxic texts of the sample (fewer, down to three, if it holds few) and log odds of `odds`; all that
    have them are kept. The driver gets terms, pairs and one pair of numbers per sampled text.
    """
    known = labelled.where(F.col("toxic").isin(0, 1)).select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    there = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    sample = known.where(hash_share(there, {1: toxic_texts, 0: other_texts}))
    sample = cut_lineage(sample.withColumn("alike", alike(F.col("text"))).dropDuplicates(["alike", "toxic"]))
    size = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_other = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_other:
        return Lexicon({}, frozenset(), -3.0, (0.0, 0.0))
    support = max(3, min(12, n_toxic // 10))
    summed = lambda df, *key: df.groupBy(*key).agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    terms = summed(sample.mapInArrow(_terms, "term string, toxic long, other long"), "term").where((F.col("toxic") >= support) & (F.col("toxic") * n_other > math.exp(odds) * n_toxic * F.col("other")))
    weights = smallest_lexicon(terms.collect(), n_toxic, n_other, odds)
    pairs = summed(sample.mapInArrow(lambda it: _pairs(weights, it), "first string, second string, toxic long, other long"), "first", "second").where((F.col("other") >= 3) & (F.col("other") * n_toxic > 5 * F.col("toxic") * n_other))
    exceptions = frozenset((r.before, r.after) for r in pairs.select(F.col("first").alias("before"), F.col("second").alias("after")).collect())
    lexicon = Lexicon(weights, exceptions, 0.0, (0.0, 0.0))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton(weights)
        for rows in texts(batches, "toxic"):
            got = [features(*measured(folded(t), words, lexicon)) for t, _ in rows]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.float64()), pa.array([t for _, t in rows], pa.int32())], names=["a", "b", "toxic"])

    rows = np.array(sorted((r.a, r.b, r.toxic) for r in sample.mapInArrow(numbers, "a double, b double, toxic int").collect()))
    bias, *slopes = logistic(rows[:, :2], rows[:, 2], np.ones(len(rows)))
    return lexicon._replace(bias=float(bias), slopes=(float(slopes[0]), float(slopes[1])))


DDL = "doc_id long, score double, matched_weight double, n_words long"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("matched_weight", pa.float64()), ("n_words", pa.int64())])


def toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), the matched weight and the number of folded words of every row; whole texts, no shuffle.

    A null or empty text has no match and the score of such a text. Repeated rows agree; a null id stays null; an empty
    table gives an empty result; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton(lexicon.weights)
        for rows in common.pieces(batches):
            got = [measured(folded(t or ""), words, lexicon) for t in rows.column("text").to_pylist()]
            x = np.array([features(*g) for g in got]) @ np.array(lexicon.slopes) + lexicon.bias
            yield common.batch(SCHEMA, rows.column("doc_id"), 1 / (1 + np.exp(-np.clip(x, -30, 30))), pa.array([float(g[0]) for g in got]), pa.array([max(g[1], 0) for g in got], pa.int64()))

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, DDL)
