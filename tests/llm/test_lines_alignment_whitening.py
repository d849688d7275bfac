import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import cases
from roadlake.llm import linededup, queries, tokenalign, whitening

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# Lines.
def keyed(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))


def dropped_lines(rows, min_documents, min_chars, keep_first):
    """The lines that go, by row: every line looked up in a table of all keys."""
    holders = {}
    for r, (doc_id, text) in enumerate(rows):
        for k, line in enumerate((text or "").split("\n")):
            if len(keyed(line)) >= min_chars:
                holders.setdefault(keyed(line), []).append(((doc_id is None, doc_id or 0, r, k), r, k))
    gone = [[] for _ in rows]
    for places in holders.values():
        if len({r for _, r, _ in places}) >= min_documents:
            for _, r, k in sorted(places)[1 if keep_first else 0 :]:
                gone[r].append(k)
    return [sorted(g) for g in gone]


def lines_of(found):
    """Per row of line_bitmaps: id, lines, and the numbers of those that go, from the bitmap."""
    out = []
    for r in found.collect():
        bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8)) if r.keep is not None else []
        gone = [k for k, b in enumerate(bits[: r.n_lines]) if not b]
        assert len(gone) == r.n_dropped
        out.append((str(r.doc_id), r.n_lines, gone))
    return sorted(out, key=str)


@pytest.mark.parametrize("rule", [(10, 1, False), (1, 1, True), (2, 3, True), (3, 1, False), (1, 1, False)])
@pytest.mark.parametrize("partitions", ["1", "13"])
def test_line_bitmaps_equal_brute_force(spark, tmp_path, rule, partitions):
    rng = np.random.default_rng(5)
    texts = ["\n".join(rng.choice(["Footer", " footer\t", "", "a", "A", "É", "é", "menu | home", "x" * 40, *(f"own {i} {k}" for k in range(3))], rng.integers(1, 9))) for i in range(60)]
    rows = [(i % 55 if i % 7 else None, t) for i, t in enumerate([*texts, None, "", "\n", "  \n\t", texts[0], texts[0]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    least, chars, first = rule
    want = sorted([(str(d), (t or "").count("\n") + 1, g) for (d, t), g in zip(rows, dropped_lines(rows, least, chars, first), strict=True)], key=str)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert lines_of(linededup.line_bitmaps(docs, min_documents=least, min_chars=chars, keep_first=first)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_runs_over_partition_edges():
    """Every way of cutting one sorted sequence into partitions settles the same lines."""
    import pyarrow as pa

    keys = [0, 0, 1, 2, 2, 2, 2, 2, 3, 4, 4]
    rows = pa.RecordBatch.from_pydict({"row": range(11), "doc_id": range(11), "high": keys, "low": [0] * 11, "first": [5] * 11, "more": [None] * 11}, schema=linededup.KEYS)
    for least, first in ((2, False), (3, False), (2, True), (3, True)):
        for one in range(12):
            for two in range(one, 12):
                parts = [list(linededup.settle(iter([rows.slice(a, min(1, b - a)), rows.slice(a + 1, max(0, b - a - 1))] if b > a else []), least, first)) for a, b in ((0, one), (one, two), (two, 11))]
                marks = [m for p in parts for batch in p for m in batch.to_pylist()]
                totals, heads = Counter(), {}
                for m in marks:
                    if m["n"]:
                        totals[m["high"]] += m["n"]
                        heads[m["high"]] = min(heads.get(m["high"], 99), m["row"])
                gone = {m["row"] for m in marks if m["high"] is None and not m["stays"]}
                gone |= {m["row"] for m in marks if m["n"] == 0 and totals[m["high"]] >= least and not (first and heads[m["high"]] == m["row"])}
                want = {r for r in range(11) if keys.count(keys[r]) >= least and not (first and keys.index(keys[r]) == r)}
                assert gone == want, (least, first, one, two)


def test_kept_text_of_awkward_rows(spark, tmp_path):
    docs = cases.stored(cases.awkward(spark), tmp_path)
    found = linededup.kept_text(linededup.line_bitmaps(docs))
    got = Counter((r.doc_id, r.text) for r in found.collect())
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got[(0, None)] == 1 and got[(1, "")] == 1 and got[(4, texts[4])] + got[(5, texts[5])] == 1  # of three equal rows one keeps its line
    assert found.count() == docs.count()
    assert linededup.line_bitmaps(docs.limit(0)).count() == 0


def test_query_lines(spark):
    docs = cases.table("0.001", "documents")
    rows = list(zip(docs.doc_id, docs.text, strict=True))
    want = {}
    for (doc_id, text), gone in zip(rows, dropped_lines(rows, 10, 1, False), strict=True):
        lines = (text or "").split("\n")
        want[doc_id] = (len(lines), len(gone), hashlib.sha256("\n".join(x for k, x in enumerate(lines) if k not in set(gone)).encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in queries.op11_shared_line_dedup(spark, SF).collect()} == want
    assert sum(w[1] for w in want.values()) > 0


# Tokens.
def brute_alignment(texts):
    """Per text the eight figures, from spans of bytes and every pair of tokens near them; libraries as their makers offer them."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    letters = {v: k for k, v in _byte_letters().items()}
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    spans, counts, out = [], Counter(), []
    for text in texts:
        raw = (" " + text).encode() if text else b""
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not a or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            spans.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        links, first = [], 0
        for i, end in enumerate(ends_a):
            start = end - len(bytes_a[i])
            while ends_b[first] <= start:
                first += 1
            j = first
            while j < len(b) and ends_b[j] - len(bytes_b[j]) < end:
                links.append((a[i], b[j]))
                j += 1
        counts.update(links)
        shared = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups = [([x for x, e in zip(a, ends_a) if lo < e <= hi], [x for x, e in zip(b, ends_b) if lo < e <= hi]) for lo, hi in zip([0, *shared], shared)] if len(shared) < 600 else None
        spans.append((len(a), len(b), len(shared), links, groups))
    highest = {}
    for (a, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    for s in spans:
        if s is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, groups = s
        digest = hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest() if groups is not None else None
        out.append((n_a, n_b, n_groups, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return out


def _byte_letters():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(own)))}


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:6] == w[:6] and (w[6] is None or g[6] == w[6]), (g, w)


def test_query_alignment(spark):
    docs = cases.table("0.001", "documents")
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_anchored_alignment(spark, SF).collect()}
    same([got[d] for d in docs.doc_id], brute_alignment(docs.text))


def test_alignment_of_awkward_rows(spark, tmp_path, monkeypatch):
    texts = [None, "", " ", "  two  blanks ", "<|endoftext|> <s></s> <0x41>", "▁ already marked", "日本語 テキスト 😀😀", "tab\tand\nline\r\n", "z" * 3000, "é \x00 \x1c", cases.prose(1, 300), cases.prose(1, 300), "un" + "believ" * 50 + "able"]
    docs = cases.stored(cases.awkward(spark, texts), tmp_path)
    rows = docs.collect()
    want = brute_alignment([r.text for r in rows])
    for size in (tokenalign.BLOCK_BYTES, 1):
        monkeypatch.setattr(tokenalign, "BLOCK_BYTES", size)  # in one block, and in many
        got = [tuple(r) for r in tokenalign.align_corpus(docs, A, B).collect()]
        key = lambda r: (str(r[0]), r[-1], r)
        same([g[1:] for g in sorted(got, key=key)], [w[1:] for w in sorted(((r.doc_id, *w) for r, w in zip(rows, want, strict=True)), key=key)])
    assert tokenalign.align_corpus(docs.limit(0), A, B).count() == 0
    assert [tuple(r)[1:] for r in tokenalign.align_corpus(docs.where("text = ''"), A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")]


# Embeddings.
def brute_whitening(ids, vectors, k=8, counted=True):
    x = np.array([[int(np.floor(np.float64(c) * 1024)) + 100000 for c in v] for v in vectors], object)
    fit = x if counted else np.array(sorted({tuple(r) for r in x}), object)
    n, sums = len(fit), fit.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = (fit - sums / n).astype(float)
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return n, deviation, np.abs((x - sums / n).astype(float) @ vecs[:, order] / np.sqrt(values[order])), values[order] / values.sum()


def check_whitening(rows, ids, vectors, counted=True):
    n, deviation, whitened, explained = brute_whitening(ids, vectors, counted=counted)
    place = {i: k for k, i in enumerate(ids)}
    assert len(rows) == 8 * len(ids)
    for r in rows:
        k = place[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation[k])
        assert abs(abs(r.whitened) - whitened[k, r.component - 1]) < 1e-6
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_query_whitening(spark):
    e = cases.table("0.001", "embeddings")
    check_whitening(queries.op13_multiplicity_whitening(spark, SF).collect(), e.vec_id.tolist(), e.embedding.tolist())


@pytest.mark.parametrize("counted", [True, False])
def test_whitening_of_repeated_and_odd_vectors(spark, counted, monkeypatch):
    rng = np.random.default_rng(2)
    good = [rng.normal(size=10).tolist() for _ in range(60)]
    good += [good[0]] * 40 + [good[1]] * 3  # a third of all rows is one vector
    odd = [None, [], [None] * 10, [float("nan")] * 10, [float("inf")] + [0.0] * 9, [1.0] * 9]
    rows = [(i, v, 7, 1) for i, v in enumerate([*good, *odd])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int, weight int")
    for hot in (1000, 5):  # broadcast more, and less
        monkeypatch.setattr(whitening, "HOT", hot)
        check_whitening(whitening.whiten(table, counted=counted).collect(), list(range(len(good))), good, counted)


def test_whitening_without_variance(spark):
    ddl = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], ddl)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], ddl)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(1, [0.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])], ddl))
    assert {r.component for r in line.collect()} == {1} and line.where(F.col("vec_id").isNull()).count() == 1
