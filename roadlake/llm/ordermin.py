"""Near duplicates by Order MinHash, verified by alignment.

The words of a text are labelled with how often each has occurred before. A sketch takes the few of the smallest hashes
and keeps them in the order of the text, so texts share a sketch if they have words in common and in the same order; that
follows edit similarity. Of texts of up to LONG words single words are taken, of longer ones runs of two: unrelated long
texts have many words in common, so that sketches of words would bring together more and more of them as the table grows.
Short texts also have exact keys: what is left of them when any few words are deleted, so that two short texts within
the allowed distance always share a key. Texts that share a key are candidates. Counts of their words by hash
bound the distance from below, so that only what may be near is fetched; an alignment of the words decides.

Within a bucket of equal sketches not all pairs are formed. Three rounds compare the bucket's members with one leader
each, and only members that are not yet in the leader's component. Of what is then still apart, all pairs of a bucket of
at most CROWD texts are compared. The texts of larger ones meet by their rarest words instead: linked texts always have one
of those in common, so that nothing is lost, and texts that only share a common passage do not meet. A pair that was turned
down is not compared again. So no two texts that share a sketch end in two components without having been compared, or
known not to be near. Exact copies are one member from the start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import drop, written
from .components import components

SKETCHES = 64
FEW, MANY = (1, 4), (2, 3)  # words of a k-mer and k-mers of a sketch, of texts of some and of more than LONG words
LONG = 40
CELLS, MOST_CELLS = 256, 4096  # of a text's word counts: four times as many from each fourfold length on
BLOCK = 1 << 16  # words that are sketched at a time
CROWD = 32  # texts of a bucket that are compared in full
SHORT = 14  # words of a text that also has exact keys, for links to texts of at most as many words
SIMILAR = 0.8  # the edit similarity that the sketches and keys are made for
#: Calculated from how many of 192 sketches agree on 6,000 texts of check_s of 15 to 600 words with one word in five replaced by a
#: new one: of such pairs of more than 40 words, fewer than one in a thousand share none of 64 sketches of three two-word runs (0.2
#: in a thousand at most where the words are drawn, 0.6 where every fifth goes); nearer pairs miss each other far less.

_MIX = np.random.default_rng(17).integers(1, 1 << 63, SKETCHES + 5, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit number for each."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def words_of(text: str) -> list[str]:
    return text.lower().split()


def kmers(words: np.ndarray, k: int) -> np.ndarray:
    """A number for each run of k words; fewer than k words are one run."""
    with np.errstate(over="ignore"):
        n = max(1, len(words) - k + 1)
        h = np.zeros(n, np.uint64)
        for j in range(min(k, len(words))):
            h += words[j : j + n] * _MIX[SKETCHES + j]
        return h


def labelled(grams: np.ndarray) -> np.ndarray:
    """Hashes of the numbers of one text, others for each further occurrence of the same number."""
    with np.errstate(over="ignore"):
        n = len(grams)
        h = mixed(grams)
        distinct, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        if len(distinct) < n:
            order = np.argsort(inverse, kind="stable")
            label = np.empty(n, np.uint64)
            label[order] = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
            h = np.where(label > 0, mixed(h + label * _MIX[-1]), h)  # a text without repeats has the same first occurrences
        return h


def families(n: int, least: float) -> list[tuple[int, int]]:
    """(K, TAKE) of the sketches of a text of n words, so that two texts whose lengths allow a link have one in common."""
    of_words = n > SHORT or int(n / least + 1e-9) > SHORT  # else all links are to texts of at most SHORT words, which have keys of their own
    return [FEW] * (of_words and n * least <= LONG + 1e-9) + [MANY] * (n > LONG)


def sketches(words: np.ndarray, family: tuple[int, int] | None = None) -> list[int]:
    """For each of SKETCHES hash orders: the smallest few k-mers, in the order of the text, as one signed number."""
    k, most = family or (MANY if len(words) > LONG else FEW)
    h = labelled(kmers(words, k))
    with np.errstate(over="ignore"):
        ranked = h[None, :] * _MIX[:SKETCHES, None]  # h is well spread already
        take = min(most, len(h))
        at = np.argpartition(ranked, take - 1, axis=1)[:, :take]
        at.sort(axis=1)
        key = np.arange(1, SKETCHES + 1, dtype=np.uint64)
        for j in range(take):
            key = mixed(key * _MIX[-2] + h[at[:, j]])
    return key.astype(np.int64).tolist()


def block_sketches(grams: np.ndarray, lengths: np.ndarray, take: int) -> np.ndarray:
    """What `sketches` gives for each of many texts, a row for each. `grams` are the k-mers of all texts, at most BLOCK; each has
    `take` or more. Of each order only the hashes below a bound that about 16 of a text pass are looked at; where fewer than `take`
    do, all of the text's are."""
    with np.errstate(over="ignore"):
        texts, n = np.repeat(np.arange(len(lengths)), lengths), len(grams)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        h = mixed(grams)
        own = mixed(h + texts.astype(np.uint64) * _MIX[-2])  # equal for equal k-mers of one text
        order = (own & ~np.uint64(BLOCK - 1)) | np.arange(n, dtype=np.uint64)
        order.sort()
        at = (order & np.uint64(BLOCK - 1)).astype(np.int64)
        alike = np.concatenate([[False], own[at[1:]] == own[at[:-1]]])
        if ((order[1:] ^ order[:-1]) < np.uint64(BLOCK))[~alike[1:]].any():  # other k-mers with the same high bits
            at = np.argsort(own, kind="stable")
            alike = np.concatenate([[False], own[at[1:]] == own[at[:-1]]])
        place = np.arange(n)
        label = np.zeros(n, np.uint64)
        label[at] = place - np.maximum.accumulate(np.where(alike, 0, place))
        h = np.where(label > 0, mixed(h + label * _MIX[-1]), h)
        bound = np.where(lengths <= 16, np.iinfo(np.uint64).max, (2.0**64 * 16 / np.maximum(lengths, 17)).astype(np.uint64))[texts]
        chosen = np.empty((SKETCHES, len(lengths), take), np.int64)
        for k in range(SKETCHES):
            ranked = h * _MIX[k]
            low = np.flatnonzero(ranked <= bound)
            of = texts[low]
            counts = np.bincount(of, minlength=len(lengths))
            before = np.cumsum(counts) - counts
            table = np.full((len(lengths), max(take, int(counts.max()))), np.iinfo(np.uint64).max)
            table[of, np.arange(len(low)) - before[of]] = ranked[low]
            least = before[:, None] + np.argpartition(table, take - 1, axis=1)[:, :take]
            chosen[k] = low[np.minimum(least, len(low) - 1)]
            for t in np.flatnonzero(counts < take).tolist():
                chosen[k, t] = starts[t] + np.argpartition(ranked[starts[t] : ends[t]], take - 1)[:take]
        chosen.sort(axis=2)
        key = np.arange(1, SKETCHES + 1, dtype=np.uint64)[:, None]
        for j in range(take):
            key = mixed(key * _MIX[-2] + h[chosen[:, :, j]])
    return key.T.astype(np.int64)


def short_keys(words: np.ndarray, least: float) -> list[int]:
    """Of a text of at most SHORT words: what is left of it without any so many words as a link to a text of at most SHORT words
    allows to be changed. A changed word is one deleted from both, so texts within that distance have a key in common."""
    longest = min(SHORT, int(len(words) / least + 1e-9)) if least > 0 else SHORT
    allowed = min(int((1 - least) * longest + 1e-9), len(words))
    left = {tuple(words.tolist())}
    every = set(left)
    for _ in range(allowed):
        left = {x[:k] + x[k + 1 :] for x in left for k in range(len(x))}
        every |= left
    return [xxhash.xxh3_64_intdigest(np.array(x, np.uint64).tobytes()) - (1 << 63) for x in sorted(every)]


def keys_of(texts: list[np.ndarray], least: float = SIMILAR) -> list[np.ndarray]:
    """The sketches of each text, and the keys of a short one."""
    keys = [np.array(short_keys(w, least), np.int64) if 0 < len(w) <= SHORT else np.zeros(0, np.int64) for w in texts]
    for family in (FEW, MANY):
        block, grams, size = [], [], 0
        for k, words in enumerate(texts):
            if not len(words) or family not in families(len(words), least):
                continue
            of = kmers(words, family[0])
            if not family[1] <= len(of) <= BLOCK:
                keys[k] = np.concatenate([keys[k], np.array(sketches(words, family), np.int64)])
                continue
            if size + len(of) > BLOCK:
                _add_sketches(block, grams, family[1], keys)
                block, grams, size = [], [], 0
            block.append(k)
            grams.append(of)
            size += len(of)
        if block:
            _add_sketches(block, grams, family[1], keys)
    return keys


def _add_sketches(block: list[int], grams: list[np.ndarray], take: int, keys: list[np.ndarray]) -> None:
    found = block_sketches(np.concatenate(grams), np.array([len(x) for x in grams]), take)
    for k, row in zip(block, found, strict=True):
        keys[k] = np.concatenate([keys[k], row]) if len(keys[k]) else row


def cells_of(n: int) -> int:
    """How many cells hold the counts of a text of n words."""
    cells = CELLS
    while cells < MOST_CELLS and n >= 2 * cells:
        cells *= 4
    return cells


def bag_of(numbers: np.ndarray) -> bytes:
    """How often each cell, the high bits of a word's hash, is met; 255 for more."""
    cells = cells_of(len(numbers))
    return np.minimum(np.bincount((numbers >> np.uint64(65 - cells.bit_length())).astype(np.int64), minlength=cells), 255).astype(np.uint8).tobytes()


def sketch(batches: Iterator[pa.RecordBatch], least: float = SIMILAR) -> Iterator[pa.RecordBatch]:
    for rows in common.pieces(batches):
        high, low, texts = [], [], []
        for text in rows.column("text").to_pylist():
            words = words_of(text or "")
            a, b = np.frombuffer(xxhash.xxh3_128_digest(" ".join(words)), "<i8").tolist()
            high.append(a)
            low.append(b)
            texts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        keys = keys_of(texts, least)
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("row"), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array([len(x) for x in texts], pa.int32()), pa.array(map(bag_of, texts), pa.binary()), listed], names=["doc_id", "row", "high", "low", "length", "bag", "keys"])


# -- alignment ---------------------------------------------------------------------------------------------------------

def trimmed(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without the words that they begin and end with in common."""
    n = min(len(x), len(y))
    same = np.flatnonzero(x[:n] != y[:n])
    head = int(same[0]) if len(same) else n
    x, y = x[head:], y[head:]
    n -= head
    same = np.flatnonzero(x[::-1][:n] != y[::-1][:n]) if n else np.zeros(0, int)
    tail = int(same[0]) if len(same) else n
    return x[: len(x) - tail], y[: len(y) - tail]


def distance(x: list[int], y: list[int], allowed: int) -> int:
    """The edit distance, or some number above `allowed` once it must be larger. A row of the alignment table is the bits of two
    numbers, where it rises and where it falls; each word of y gives the next row by a few operations on whole numbers."""
    if len(x) < len(y):
        x, y = y, x
    places: dict[int, int] = {}
    bit = 1
    for word in x:
        places[word] = places.get(word, 0) | bit
        bit <<= 1
    every, last, score, left = bit - 1, bit >> 1, len(x), len(y)
    rises, falls = every, 0
    for word in y:
        same = places.get(word, 0)
        down = same | falls
        across = (((same & rises) + rises) ^ rises) | same
        more, less = falls | (every & ~(across | rises)), rises & across
        left -= 1
        if more & last:
            score += 1
        elif less & last:
            score -= 1
        if score - left > allowed:
            return score - left
        more, less = more << 1 | 1, less << 1
        rises, falls = (less | ~(down | more)) & every, more & down & every
    return score


def alike(pairs: Iterable[tuple[np.ndarray, np.ndarray]], least: float) -> np.ndarray:
    """Whether the edit similarity, 1 - distance / longer length, of each pair of word sequences is at least `least`. A bound
    from the words that both have, whatever their order, goes before the alignment."""
    verdict = []
    for x, y in pairs:
        allowed = int((1 - least) * max(len(x), len(y)) + 1e-9)
        x, y = trimmed(x, y) if abs(len(x) - len(y)) <= allowed else (x, y)
        near = abs(len(x) - len(y)) <= allowed
        if near and max(len(x), len(y)) > allowed:
            _, numbers = np.unique(np.concatenate([x, y]), return_inverse=True)
            cells = int(numbers.max()) + 1
            shared = int(np.minimum(np.bincount(numbers[: len(x)], minlength=cells), np.bincount(numbers[len(x) :], minlength=cells)).sum())
            near = max(len(x), len(y)) - shared <= allowed and distance(numbers[: len(x)].tolist(), numbers[len(x) :].tolist(), allowed) <= allowed
        verdict.append(near)
    return np.array(verdict, bool)


class Numbers(dict):
    """row -> the words of its text as numbers, equal for equal words; forgets all beyond `most` words."""

    def __init__(self, most: int = 1 << 20):
        self.most, self.held = most, 0

    def of(self, row: int, text: str) -> np.ndarray:
        if row not in self:
            words = words_of(text)
            if self.held + len(words) > self.most:
                self.clear()
                self.held = 0
            self[row] = np.fromiter(map(hash, words), np.int64, len(words))
            self.held += len(words)
        return self[row]


def verify(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of (a, b, text_a, text_b) that align."""
    numbers = Numbers()
    for rows in common.pieces(batches, "text_a"):
        columns = [rows.column(c) for c in ("a", "text_a", "b", "text_b")]
        pairs = ((numbers.of(a.as_py(), x.as_py()), numbers.of(b.as_py(), y.as_py())) for a, x, b, y in zip(*columns, strict=True))
        kept = rows.filter(pa.array(alike(pairs, least)))
        yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])


# -- the whole table ---------------------------------------------------------------------------------------------------


def folded(bags: list[bytes], cells: int) -> np.ndarray:
    """Bags of one size as rows of at most `cells` counts: cells that share their high bits are added up."""
    counts = np.frombuffer(b"".join(bags), np.uint8).reshape(len(bags), cells, -1)
    return (np.minimum(counts.sum(axis=2), 255) if counts.shape[2] > 1 else counts[:, :, 0]).astype(np.int16)


def possible(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of (a, b, length_a, length_b, bag_a, bag_b) whose word counts allow a link: an edit takes at most one
    word away and brings at most one, so either surplus is a lower bound of the distance."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            rows = batch.slice(start, 1000)
            xs, ys = (rows.column(c).to_pylist() for c in ("bag_a", "bag_b"))
            sizes: dict[tuple[int, int], list[int]] = {}
            for k, (x, y) in enumerate(zip(xs, ys, strict=True)):
                sizes.setdefault((len(x), len(y)), []).append(k)
            surplus = np.zeros(len(xs), np.int64)
            for size, of in sizes.items():
                more = folded([xs[k] for k in of], min(size)) - folded([ys[k] for k in of], min(size))
                rise, fall = np.maximum(more, 0).sum(axis=1, dtype=np.int64), np.maximum(-more, 0).sum(axis=1, dtype=np.int64)
                surplus[of] = np.maximum(rise, fall)
            longer = np.maximum(rows.column("length_a").to_numpy(), rows.column("length_b").to_numpy())
            kept = rows.filter(pa.array(surplus <= ((1 - least) * longer + 1e-9).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])


def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, length, word) for each word of (row, text), each further occurrence of a word as another word."""
    for rows in common.pieces(batches):
        texts = [words_of(text or "") for text in rows.column("text").to_pylist()]
        found = [labelled(kmers(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), 1)) if words else np.zeros(0, np.uint64) for words in texts]
        lengths = np.array([len(x) for x in found])
        at = pa.array(np.repeat(np.arange(len(found)), lengths))
        yield pa.RecordBatch.from_arrays([rows.column("row").take(at), pa.array(np.repeat(lengths, lengths).astype(np.int32)), pa.array(np.concatenate(found).view(np.int64))], names=["row", "length", "word"])


def rare_words(texts: DataFrame, least: float) -> DataFrame:
    """(row, word), written: of each text the rarest words by the number of these texts that have them, one more than a link to a
    text of any length leaves out, without those that no other text has. Texts that are linked have most of their words in
    common, so in one order of all words their first common word is among the rarest of both."""
    words = written(texts.mapInArrow(elements, "row long, length int, word long"))
    counted = words.withColumn("n", F.count("*").over(Window.partitionBy("word")))
    place = F.row_number().over(Window.partitionBy("row").orderBy("n", "word"))
    ranked = counted.withColumn("place", place)
    rare = written(ranked.where((F.col("place") <= F.floor((1 - least) * F.col("length") + 1e-9) + 1) & (F.col("n") > 1)).select("row", "word"))
    drop(words)
    return rare


def linked(pairs: DataFrame, bags: DataFrame, texts: DataFrame, least: float) -> DataFrame | None:
    """The pairs that align, written; None if word counts allow none. Only the texts of pairs that they allow travel."""
    of = lambda end: bags.select(F.col("row").alias(end), F.col("length").alias(f"length_{end}"), F.col("bag").alias(f"bag_{end}"))
    counted = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "length_a", "length_b", "bag_a", "bag_b")
    pairs = written(counted.mapInArrow(lambda it: possible(it, least), "a long, b long"))
    if pairs.isEmpty():
        drop(pairs)
        return None
    ends = written(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct())
    texts = texts.join(ends, "row", "left_semi")
    with_b = pairs.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
    found = written(with_both.select("a", "b", "text_a", "text_b").mapInArrow(lambda it: verify(it, least), "a long, b long"))
    drop(pairs, ends)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """doc_id, class_id, n_copies, n_links, kept of every row: class_id is the smallest doc_id of its class.

    A class is a connected component of the links, exact copies (the same words but for case and blanks) and pairs of an
    edit similarity of `least` over words. n_copies counts the rows with the same words, n_links the links found to other
    texts (a lower bound within a component, since links that would join nothing new are not looked for); `kept` marks
    one row of each class: the first of its smallest id. `row` is the row's number in the one pass that reads `docs`.

    Links between texts of at most SHORT words are all found. Longer pairs must share a sketch, which those of exactly 0.8
    fail to with about one in a thousand and those of 0.9 practically never; sketches are made for a `least` of SIMILAR or
    more, and with less the pairs below SIMILAR are found only by chance.

    Null, empty and blank texts have no words and are each a class of their own. Repeated rows are copies. Rows without an id come last in order and have a null class
    if the whole class has none. An empty table gives an empty result; other columns are not read.
    """
    return placed_rows(common.numbered(common.id_and_text(docs, id_col, text_col), "row"), least)


def placed_rows(rows: DataFrame, least: float) -> DataFrame:
    """What `near_duplicates` gives, for a written table of doc_id, text, row."""
    sketched = written(rows.mapInArrow(lambda it: sketch(it, least), "doc_id long, row long, high long, low long, length int, bag binary, keys array<long>"))
    ids = written(sketched.select("doc_id", "row", "high", "low", "length"))
    order = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "row")
    copies = written(ids.where("length > 0").groupBy("high", "low").agg(F.min(order).alias("order"), F.count("*").alias("n_copies")).select("high", "low", "n_copies", "order", F.col("order.row").alias("row")))
    chosen = written(sketched.join(copies, "row", "left_semi").select("row", "length", "bag", "keys"))
    drop(sketched)

    keyed = chosen.select("row", "length", F.explode("keys").alias("key"))
    bucket = Window.partitionBy("key")
    met = keyed.select("key", "row", "length", F.count("*").over(bucket).alias("n"), F.min("row").over(bucket).alias("lead_0"), F.max("row").over(bucket).alias("lead_1"), F.min_by("row", F.xxhash64("row")).over(bucket).alias("lead_2"))
    members = written(met.where("n > 1").drop("n"))  # keys travel once
    known = written(members.select("row").distinct().withColumn("component", F.col("row")))
    bags = written(chosen.join(known, "row", "left_semi").select("row", "length", "bag"))
    drop(chosen)
    texts = rows.select("row", "text")

    links, asked = None, []
    for turn in range(4):
        placed = members.join(known, "row")
        if turn == 3:  # leaders have met all of their bucket
            placed = placed.where((F.col("row") != F.col("lead_0")) & (F.col("row") != F.col("lead_1")) & (F.col("row") != F.col("lead_2")))
        if turn:  # only buckets whose members are not all in one component
            apart = written(placed.groupBy("key").agg((F.min("component") != F.max("component")).alias("apart"), (F.count("*") > CROWD).alias("crowd")).where("apart").select("key", "crowd"))
            placed = written(placed.join(apart, "key"))
            drop(apart)
        else:
            placed = written(placed)
        if placed.isEmpty():
            drop(placed)
            break
        if turn < 3:
            leaders = as_leaders(placed.where(F.col("row") == F.col(f"lead_{turn}")))
            pairs = meetings(placed, leaders, F.col("row") != F.col("a"), least)
        else:  # the rest: in full, or what of a crowd has a rare word in common
            few = placed.where(~F.col("crowd"))
            crowd = written(placed.where("crowd").select("row", "length", "component").distinct())
            rare = rare_words(texts.join(crowd, "row", "left_semi"), least)
            of_word = rare.join(crowd, "row").withColumnRenamed("word", "key")
            pairs = meetings(few, as_leaders(few), F.col("row") > F.col("a"), least).union(meetings(of_word, as_leaders(of_word), F.col("row") > F.col("a"), least))
        pairs = pairs.distinct()
        for before in asked:  # a pair that was turned down is not asked again where it shares another sketch
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = written(pairs)
        drop(placed, *((crowd, rare) if turn == 3 else ()))
        asked.append(pairs)
        found = None if pairs.isEmpty() else linked(pairs, bags, texts, least)
        if found is None or found.isEmpty():
            continue
        links = found if links is None else links.union(found)
        of = lambda end: known.select(F.col("row").alias(end), F.col("component").alias(f"component_{end}"))
        moved = components(found.join(of("a"), "a").join(of("b"), "b").select(F.col("component_a").alias("a"), F.col("component_b").alias("b")))
        moved = moved.select(F.col("node").alias("component"), F.col("component").alias("joined"))
        before, known = known, written(known.join(moved, "component", "left").select("row", F.coalesce("joined", "component").alias("component")))
        drop(before)
    drop(members, bags, *asked)
    return classes(ids, copies, links, known, order)


def as_leaders(placed: DataFrame) -> DataFrame:
    return placed.select("key", F.col("row").alias("a"), F.col("length").alias("length_a"), F.col("component").alias("component_a"))


def meetings(placed: DataFrame, leaders: DataFrame, other: Column, least: float) -> DataFrame:
    """The pairs (a, b) of one key that are in two components and near enough in length."""
    lengths = (F.col("length_a") * least <= F.col("length")) & (F.col("length") * least <= F.col("length_a"))
    pairs = placed.join(leaders, "key").where((F.col("component") != F.col("component_a")) & lengths & other)
    return pairs.select(F.least("a", "row").alias("a"), F.greatest("a", "row").alias("b"))


def first_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """The rows of `docs` that are the first of their class, with all their columns; see `near_duplicates`."""
    rows = common.numbered(docs.toDF(*(f"c{k}" for k in range(len(docs.columns)))), "row")
    of = lambda name: F.col(f"c{docs.columns.index(name)}")
    kept = placed_rows(rows.select(of(id_col).cast("long").alias("doc_id"), of(text_col).alias("text"), "row"), least).where("kept").select("row")
    return rows.join(kept, "row", "left_semi").drop("row").toDF(*docs.columns)


def classes(ids: DataFrame, copies: DataFrame, links: DataFrame, known: DataFrame, order: Column) -> DataFrame:
    links = links if links is not None else known.select(F.col("row").alias("a"), F.col("row").alias("b")).limit(0)
    degree = links.select(F.col("a").alias("row")).union(links.select("b")).groupBy("row").agg(F.count("*").alias("n_links"))
    placed = copies.join(known, "row", "left").join(degree, "row", "left").select("high", "low", "order", "n_copies", F.coalesce("component", "row").alias("component"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    first = written(placed.groupBy("component").agg(F.min("order").alias("first")))  # joined as a scan: a large class can be split
    of_words = placed.join(first, "component").select("high", "low", "n_copies", "n_links", "first")
    joined = ids.join(of_words, ["high", "low"], "left")
    alone = F.col("length") == 0
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), F.when(alone, F.lit(1).cast("long")).otherwise(F.col("n_copies")).alias("n_copies"),
        F.when(alone, F.lit(0).cast("long")).otherwise(F.col("n_links")).alias("n_links"), (alone | (F.col("row") == F.col("first.row"))).alias("kept"), "row")
