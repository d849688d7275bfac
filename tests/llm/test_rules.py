import random
import re
from collections import Counter

import numpy as np
import pytest

import cases
from roadlake.llm import licenses, queries, repetition

SF = "/root/testdata/sf0.001"


def longest_at_each(words):
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            n = 0
            while i != j and max(i, j) + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            best = max(best, n)
        out.append(best)
    return out


def test_repeat_lengths():
    rng = random.Random(2)
    for _ in range(150):
        _, words = np.unique([rng.randrange(3) for _ in range(rng.randrange(1, 30))], return_inverse=True)
        assert repetition.repeat_lengths(words).tolist() == longest_at_each(words.tolist())


def quality_by_hand(text, min_repeat=8, max_covered=0.5, max_repeat=120):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    lengths = longest_at_each(words) if len(words) < 400 else repetition.repeat_lengths(np.unique(words, return_inverse=True)[1]).tolist()
    covered = {i + k for i, n in enumerate(lengths) if n >= min_repeat for k in range(n)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed,
            not failed and len(covered) <= max_covered * len(words) and max(lengths, default=0) <= max_repeat)


def test_query_quality(spark):
    docs = cases.table("0.001", "documents")
    got = {r.doc_id: tuple(r)[1:8] for r in queries.op3_suffix_repetition(spark, SF).collect()}
    assert got == {d: quality_by_hand(t) for d, t in zip(docs.doc_id, docs.text, strict=True)}


def test_quality_of_awkward_rows(spark):
    docs = cases.awkward(spark)
    got = sorted(((r.doc_id is None, r.doc_id), tuple(r)[1:8]) for r in repetition.repetition_quality(docs).collect())
    assert got == sorted(((r.doc_id is None, r.doc_id), quality_by_hand(r.text)) for r in docs.collect())
    assert repetition.repetition_quality(docs.limit(0)).count() == 0
    kept = repetition.kept_rows(docs)
    assert kept.columns == docs.columns and sorted(r.text for r in kept.collect()) == sorted(r.text for r in docs.collect() if quality_by_hand(r.text)[-1])


def test_long_repeats_fail_and_spans_cover_them(spark):
    part = cases.prose(5, 130)
    docs = spark.createDataFrame([(1, part + " " + cases.prose(6, 900) + " " + part), (2, cases.prose(7, 900))], "doc_id long, text string")
    got = {r.doc_id: r for r in repetition.repetition_quality(docs).collect()}
    assert not got[1].base_failed and not got[1].kept and got[1].longest_repeat >= 130
    assert [(s.start, s.end) for s in got[1].spans][0][0] == 0 and got[1].spans[-1].end == got[1].n_words and len(got[1].spans) == 2
    assert got[2].kept and got[2].spans == []


def base_by_hand(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")) for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def test_query_licenses(spark):
    docs = cases.table("0.1", "documents")
    got = {r.doc_id: tuple(r)[1:6] for r in queries.op4_license_scan(spark, "/root/testdata/sf0.1").collect()}
    assert got == {d: base_by_hand(t) for d, t in zip(docs.doc_id, docs.text, strict=True)}
    assert sum(g[1] for g in got.values()) > 0


def test_license_of_awkward_rows(spark):
    docs = cases.awkward(spark, [None, "", "CC-BY 4.0, cc_by; CCBY", "all rights\nreserved ALL RIGHTS RESERVED", "éall rights reserved", cases.prose(1, 9000) + " GNU General Public License v3"])
    got = {(r.doc_id, tuple(r)[1:6]) for r in licenses.license_scan(docs).collect()}
    assert got == {(r.doc_id, base_by_hand(r.text)) for r in docs.collect()}
    assert licenses.license_scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text, labels", [
    ("Released under the MIT License.", {"mit"}), ("Licensed under the Apache License, Version 2.0", {"apache-2.0", "apache"}), ("SPDX-License-Identifier: GPL-3.0", {"gpl"}),
    ("GNU Lesser General Public License", {"lgpl"}), ("the permit of a limited apache tribe", set()), ("This work is in the public domain", {"public-domain"}),
    ("Redistribution and use in source and binary forms", {"bsd"}), ("CC BY-SA 4.0", {"cc-by-sa-4.0"}), ("submit license-free vim", set()),
])
def test_rules(text, labels):
    base, found = licenses.scan(text.encode().translate(licenses.LOWER).decode())
    assert {d["label"] for d in found} == labels


def test_rules_are_hundreds_and_each_can_be_reached_through_its_keyword():
    found = licenses.rules()
    assert 200 <= len(found) <= 900 and [r.priority for r in found] == sorted((r.priority for r in found), reverse=True)
    for rule in found:
        plain = re.sub(r"\(\?<?[:!=][^()]*\)|\[[^]]*\]", " ", rule.pattern.pattern)
        assert rule.keyword in plain or rule.keyword in rule.pattern.pattern


def test_containment():
    rule = lambda priority: licenses.Rule("x", re.compile("x"), "x", 1.0, priority)
    inside, outer, other = (4, 6, rule(20_000)), (0, 10, rule(30_000)), (8, 14, rule(10_000))
    assert licenses.settle([inside, other, outer]) == [outer, other]
    assert Counter(h[2].priority for h in licenses.settle([(0, 3, rule(9)), (0, 3, rule(5))])) == Counter([9])
