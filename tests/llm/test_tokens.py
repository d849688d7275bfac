import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import cases
from roadlake.llm import bytepair, packing, queries, tokens

MULTI, PLAIN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def strings():
    rng = random.Random(3)
    return [None, "", " ", " \n", "a  b   c\n\n d\x1c e\x1d\x1df \x85\xa0x  ", "don't I'll 'sx <|endoftext|> 日本語 123 ١٢٣ 😀😀 \t\t x\r\n\r\n y", "z" * 5000, cases.prose(1, 3000), *("".join(rng.choices(" \n\t'sdx.1é\x1c\xa0日", k=rng.randrange(40))) for _ in range(300))]


def test_words_join_to_the_text_and_encode_alone():
    encode = tokens.encoding(MULTI).encode_ordinary
    for text in filter(None, strings()):
        words = tokens.words(text)
        assert "".join(words) == text
        assert [i for w in words for i in encode(w)] == encode(text)


def digests(text):
    ids = tokens.encoding(MULTI).encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_bpe(spark):
    docs = cases.table("0.001", "documents")
    got = {r.doc_id: tuple(r)[1:] for r in queries.op5_distinct_word_bpe(spark, SF).collect()}
    assert got == {d: digests(t) for d, t in zip(docs.doc_id, docs.text, strict=True)}


def test_bpe_of_awkward_rows(spark, tmp_path, monkeypatch):
    docs = cases.stored(cases.awkward(spark, strings()), tmp_path)
    got = sorted((str(r.doc_id), tuple(r)[1:]) for r in bytepair.encode_corpus(docs, MULTI, groups=3).collect())
    assert got == sorted((str(r.doc_id), digests(r.text)) for r in docs.collect())
    assert bytepair.encode_corpus(docs.limit(0), MULTI).count() == 0
    assert {tuple(r)[1] for r in bytepair.encode_corpus(docs.where("text is null"), MULTI).collect()} == {0}


def whole(pieces, docs, encode):
    """Checks what must hold of every packing; returns the share of padding."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(docs)
    for doc_id, parts in by_doc.items():
        ids = np.array([*encode(docs[doc_id] or ""), 1], "<u4")
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            assert zlib.crc32(ids[at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)
    padding = total = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / total


def test_query_packing(spark):
    tokenizer = Tokenizer.from_file(PLAIN)
    tokenizer.encode_special_tokens = True
    docs = cases.table("0.001", "documents")
    share = whole(queries.op10_dynamic_packing(spark, SF).collect(), dict(zip(docs.doc_id, docs.text, strict=True)), lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    assert share < 0.02


def test_packing_of_awkward_rows(spark, tmp_path):
    docs = cases.awkward(spark, strings()).where("doc_id is not null").dropDuplicates(["doc_id"])
    whole(packing.pack_sequences(cases.stored(docs, tmp_path), PLAIN).collect(), {r.doc_id: r.text for r in docs.collect()}, tokens.encoding(PLAIN).encode_ordinary)
    assert packing.pack_sequences(docs.limit(0), PLAIN).count() == 0
    twice = packing.pack_sequences(cases.awkward(spark).union(cases.awkward(spark)), PLAIN)
    assert twice.where("start = 0").count() == 2 * cases.awkward(spark).count()


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_cuts(seed):
    """Against the plain recursion over all places."""
    rng = random.Random(seed)
    window, n = 8, rng.randrange(1, 60)
    places = sorted({*rng.sample(range(1, n + 1), rng.randrange(0, n)), *range(3, n, 3), n})
    prices = [rng.randrange(0, 6) for _ in places]
    at, price = [0, *places], [0, *prices]
    best = [0.0] + [float("inf")] * len(places)
    pad = lambda length: 0 if length in (window // 2, window // 4) else window - length
    for k in range(1, len(at)):
        best[k] = min(best[i] + pad(at[k] - at[i]) for i in range(k) if at[k] - at[i] <= window) + price[k]
    cuts = packing.best_cuts(np.array(places), np.array(prices), window)[::-1]
    cost = sum(pad(b - a) + price[at.index(b)] for a, b in zip([0, *cuts], cuts, strict=False))
    assert cuts[-1] == n and cost == best[-1]
