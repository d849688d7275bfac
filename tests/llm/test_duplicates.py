import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

import cases
import corpus_pipeline
from roadlake.llm import common, components, ordermin, queries, unitdedup

SF = "/root/testdata/sf0.001"


def distance(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        new = [i]
        for j, b in enumerate(y, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row[-1]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words) + 1)
        words[k : k + rng.randrange(2)] = [rng.choice(cases.WORDS)] * rng.randrange(2)
    return words


def test_alignment_decides_as_the_full_table_does():
    rng = random.Random(5)
    pairs = []
    for _ in range(200):
        x = [rng.randrange(6) for _ in range(rng.randrange(0, 50))]
        pairs.append((np.array(x, np.int64), np.array([rng.randrange(6) if rng.random() < 0.1 else v for v in x if rng.random() > 0.1], np.int64)))
    want = [distance(a.tolist(), b.tolist()) <= int(0.2 * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    assert ordermin.alike(pairs, 0.8).tolist() == want and 20 < sum(want) < 180


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_query_classes_hold_all_pairs_of_similar_shingles(spark):
    docs = cases.table("0.001", "documents")
    got = {r.doc_id: r for r in queries.op7_order_minhash(spark, SF).collect()}
    assert sorted(got) == sorted(docs.doc_id)
    sets = {d: shingles(t) for d, t in zip(docs.doc_id, docs.text, strict=True)}
    words = {d: t.lower().split() for d, t in zip(docs.doc_id, docs.text, strict=True)}
    alike = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert alike and all(got[a].class_id == got[b].class_id for a, b in alike)
    members = defaultdict(list)
    for d, r in got.items():
        members[r.class_id].append(d)
    for first, ids in members.items():
        assert first == min(ids) and [d for d in ids if got[d].kept] == [first]
        reached = {first}
        for _ in ids:
            reached |= {d for d in ids for e in reached if d not in reached and distance(words[d], words[e]) <= 0.2 * max(len(words[d]), len(words[e])) + 1e-9}
        assert reached == set(ids)


def test_classes_of_a_crowd_of_near_copies_and_awkward_rows(spark, tmp_path):
    rng = random.Random(8)
    base = cases.prose(4, 200).split()
    crowd = [" ".join(edited(rng, base, 3)) for _ in range(60)]
    texts = [None, "", " \n", "x", "X ", cases.prose(2, 20000), cases.prose(2, 19990), *crowd]
    docs = cases.stored(cases.awkward(spark, texts), tmp_path)
    got = ordermin.near_duplicates(docs).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == docs.count()
    assert [by_id[d].class_id for d in (0, 1, 2)] == [0, 1, 2]
    assert by_id[4].class_id == 3 and by_id[3].n_copies == 3
    assert by_id[6].class_id == 5
    assert {by_id[d].class_id for d in range(7, 67)} == {7}
    assert sum(r.kept for r in got) == 7 and [r.class_id for r in got if r.doc_id is None] == [None]
    kept = ordermin.first_of_each_class(docs)
    assert kept.columns == docs.columns and kept.count() == 7
    assert ordermin.near_duplicates(docs.limit(0)).count() == 0


def test_pairs_of_a_crowded_bucket_that_share_nothing_else_are_compared(spark, tmp_path, monkeypatch):
    texts = []
    for k in range(10):  # at most three of the ten pairs have a leader
        words = cases.prose(400 + k, 60).split()
        texts += [" ".join(words), " ".join(edited(random.Random(k), words, 2)) + " end"]
    real = ordermin.sketch

    def one_bucket(batches, least):
        for rows in real(batches, least):
            keys = pa.array([[1, 100 + r] for r in rows.column("row").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], keys], names=rows.schema.names)

    monkeypatch.setattr(ordermin, "sketch", one_bucket)
    docs = cases.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tmp_path)
    assert {r.doc_id: r.class_id for r in ordermin.near_duplicates(docs).collect()} == {k: k - k % 2 for k in range(20)}


def test_many_texts_are_sketched_as_one_by_one():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 1 << 63, n, dtype=np.uint64)[rng.integers(0, max(1, n // 2), n)] for n in [12, 13, 15, 16, 17, 18, 40, 300, 5000, 70_000] * 3]
    keys = ordermin.keys_of(texts)
    for words, got in zip(texts, keys, strict=True):
        assert got[len(got) - ordermin.SKETCHES :].tolist() == ordermin.sketches(words)


def test_distances_of_long_texts_are_exact_up_to_the_allowed():
    rng = random.Random(6)
    for n in (1, 2, 30, 31, 64, 200):
        x = [rng.randrange(9) for _ in range(n)]
        y = [rng.randrange(9) if rng.random() < 0.1 else w for w in x if rng.random() > 0.05] + [3]
        d = distance(x, y)
        assert ordermin.distance(x, y, n) == ordermin.distance(y, x, n + 1) == d
        assert d == 0 or ordermin.distance(x, y, d - 1) >= d


def test_counts_of_long_texts_tell_texts_of_the_same_words_apart():
    """Texts of thousands of words over one vocabulary: 256 counts allow what more of them rule out."""
    rng = np.random.default_rng(5)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([0, 1]), pa.array([" ".join(f"w{k}" for k in rng.integers(0, 4000, 8000)) for _ in range(2)])], names=["doc_id", "row", "text"])
    a, b = pa.Table.from_batches(ordermin.sketch(iter([batch]))).to_pylist()
    asked = pa.RecordBatch.from_pylist([{"a": 0, "b": 1, "length_a": a["length"], "length_b": b["length"], "bag_a": a["bag"], "bag_b": b["bag"]}])
    assert sum(x.num_rows for x in ordermin.possible(iter([asked]), 0.8)) == 0


def test_a_pair_is_asked_once_and_tables_leave_the_disk(spark, tmp_path, monkeypatch):
    texts = [cases.prose(700 + k, 60) for k in range(6)]
    real, sketch, asked = ordermin.linked, ordermin.sketch, []

    def one_bucket(batches, least):
        for rows in sketch(batches, least):
            keys = pa.array([[1, 2, 3]] * rows.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], keys], names=rows.schema.names)

    def linked(pairs, *more):
        asked.extend((r.a, r.b) for r in pairs.collect())
        return real(pairs, *more)

    monkeypatch.setattr(ordermin, "sketch", one_bucket)
    monkeypatch.setattr(ordermin, "linked", linked)
    docs = cases.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tmp_path)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.glob("table-*"))
    assert {r.doc_id: r.class_id for r in ordermin.near_duplicates(docs).collect()} == {k: k for k in range(6)}
    assert len(asked) == len(set(asked)) == 15
    assert len(set(folder.glob("table-*")) - before) <= 5  # rows, ids, copies, components, first of each class


def asked_pairs(monkeypatch):
    real, asked = ordermin.linked, []

    def linked(pairs, *more):
        asked.extend((r.a, r.b) for r in pairs.collect())
        return real(pairs, *more)

    monkeypatch.setattr(ordermin, "linked", linked)
    return asked


def test_a_common_passage_does_not_bring_all_its_texts_together(spark, tmp_path, monkeypatch):
    """Half of each text is the same passage: they share sketches, but only planted pairs have rare words in common. Of 46,665
    pairs the leaders of 64 buckets ask about one in six."""
    rng, passage = random.Random(31), cases.prose(1, 60)
    own = [" ".join(f"w{rng.randrange(1 << 40)}" for _ in range(60)) for _ in range(300)]
    texts = [f"{x} {passage}" for x in own] + [f"{' '.join(replaced(rng, x.split(), 12))} {passage}" for x in own[:6]]
    asked = asked_pairs(monkeypatch)
    monkeypatch.setattr(ordermin, "CROWD", 8, raising=False)
    docs = cases.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tmp_path)
    assert {r.doc_id: r.class_id for r in ordermin.near_duplicates(docs).collect()} == {k: k % 300 for k in range(306)}
    assert len(asked) == len(set(asked)) < 12_000


def test_unrelated_long_texts_of_one_vocabulary_share_no_sketch():
    """Texts of 300 words that all have most of their words in common: what they share must not grow with their pairs."""
    rng = np.random.default_rng(9)
    words = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    keys = [set(k.tolist()) for k in ordermin.keys_of([words[rng.integers(0, 400, 300)] for _ in range(100)])]
    assert sum(bool(keys[a] & keys[b]) for a in range(100) for b in range(a)) < 10


@pytest.mark.parametrize("n", [10, 33, 60, 150])
def test_linked_texts_of_a_crowd_have_a_rare_word_in_common(spark, tmp_path, n):
    rng = random.Random(n)
    words = [f"w{k}" for k in range(40)]
    texts = []
    for _ in range(25):
        x = [rng.choice(words) for _ in range(n)]
        texts += [" ".join(x), " ".join(edited(rng, x, n // 4))]
    docs = cases.stored(spark.createDataFrame(list(enumerate(texts)), "row long, text string"), tmp_path)
    rare = defaultdict(set)
    for r in ordermin.rare_words(docs, 0.8).collect():
        rare[r.row].add(r.word)
    split = [t.split() for t in texts]
    near = [(a, b) for a in range(50) for b in range(a) if distance(split[a], split[b]) <= int(0.2 * max(len(split[a]), len(split[b])) + 1e-9)]
    assert len(near) > 10 and all(rare[a] & rare[b] for a, b in near)


def replaced(rng, words, n):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"new{rng.randrange(1 << 40)}"
    return words


def test_pairs_at_the_stated_similarity_are_linked_as_by_brute_force(spark, tmp_path):
    """Isolated pairs from one edit in few words to one word in five, among all pairs by the full alignment table."""
    rng = random.Random(21)
    texts = []
    for k, n in enumerate([4, 5, 6, 9, 10, 12, 13, 14, 15, 17, 20, 25, 40, 60, 100, 100, 100] * 3):
        words = cases.prose(600 + k, n).split()[:n]
        other = replaced(rng, words, max(1, n // 5)) if n > 4 else [*words, "end"]
        if 5 < n < 14 and k % 2:
            other = [*words[1:], "end"][: n - 1 + k % 3]
        texts += [" ".join(words), " ".join(other)]
    split = [t.lower().split() for t in texts]
    near = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if abs(len(split[a]) - len(split[b])) <= 0.2 * max(len(split[a]), len(split[b])) + 1e-9 and distance(split[a], split[b]) <= 0.2 * max(len(split[a]), len(split[b])) + 1e-9]
    assert len(near) >= 45
    docs = cases.stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tmp_path)
    got = {r.doc_id: r.class_id for r in ordermin.near_duplicates(docs).collect()}
    assert [(a, b) for a, b in near if got[a] != got[b]] == []


def test_short_texts_within_the_allowed_distance_share_a_key():
    rng = random.Random(4)
    texts = [np.array([rng.randrange(1, 4) for _ in range(rng.randrange(1, 15))], np.uint64) for _ in range(160)]
    keys = [set(ordermin.short_keys(t, 0.8)) for t in texts]
    near = [(a, b) for a in range(160) for b in range(a) if distance(texts[a].tolist(), texts[b].tolist()) <= int(0.2 * max(len(texts[a]), len(texts[b])) + 1e-9)]
    assert len(near) > 20 and all(keys[a] & keys[b] for a, b in near)


def test_word_counts_drop_no_link():
    rng = random.Random(12)
    rows = []
    for k in range(300):
        x = cases.prose(k, rng.choice([3, 12, 80, 700])).split()
        rows += [(2 * k, " ".join(x)), (2 * k + 1, " ".join(edited(rng, x, len(x) // 4)))]
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows]), pa.array([k for k, _ in rows]), pa.array([t for _, t in rows])], names=["doc_id", "row", "text"])
    got = [r for b in ordermin.sketch(iter([batch])) for r in b.to_pylist()]
    pairs = [(a, b) for k in range(300) for a, b in ((got[2 * k], got[2 * k + 1]), (got[2 * k], got[(2 * k + 40) % 600]))]
    asked = pa.RecordBatch.from_pylist([{"a": a["row"], "b": b["row"], "length_a": a["length"], "length_b": b["length"], "bag_a": a["bag"], "bag_b": b["bag"]} for a, b in pairs])
    kept = {(r["a"], r["b"]) for b in ordermin.possible(iter([asked]), 0.8) for r in b.to_pylist()}
    number = {w: i for i, w in enumerate(sorted({w for _, t in rows for w in t.lower().split()}))}
    words = {k: np.array([number[w] for w in t.lower().split()]) for k, t in rows}
    near = ordermin.alike([(words[a["row"]], words[b["row"]]) for a, b in pairs], 0.8)
    true = {(a["row"], b["row"]) for (a, b), yes in zip(pairs, near.tolist(), strict=True) if yes}
    assert len(true) > 100 and true <= kept and len(kept) < 450


def test_a_text_with_a_repeat_meets_one_without():
    words = np.arange(1, 201, dtype=np.uint64) * np.uint64(7919)
    again = words.copy()
    again[100] = again[20]
    assert sum(a == b for a, b in zip(ordermin.sketches(words), ordermin.sketches(again), strict=True)) > ordermin.SKETCHES // 2


@pytest.fixture
def moving_splits(spark, monkeypatch):
    """Every table that is written changes how the files of the next scan are dealt to tasks."""
    real, turn = common.written, [0]

    def written(df):
        out = real(df)
        turn[0] += 1
        conf = df.sparkSession.conf
        conf.set("spark.sql.files.openCostInBytes", "1" if turn[0] % 2 else str(64 << 20))
        conf.set("spark.sql.files.minPartitionNum", "1" if turn[0] % 2 else "8")
        return out

    for module in (common, ordermin):
        monkeypatch.setattr(module, "written", written)
    yield
    spark.conf.unset("spark.sql.files.openCostInBytes")
    spark.conf.unset("spark.sql.files.minPartitionNum")


def scattered(spark, tmp_path, rows, ddl="doc_id long, text string"):
    path = str(tmp_path / "scattered.parquet")
    spark.createDataFrame(rows, ddl).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def test_passages_stay_once_when_later_scans_are_split_otherwise(spark, tmp_path, moving_splits):
    passage = cases.prose(90, 60)
    docs = scattered(spark, tmp_path, [(k, cases.prose(k, 40) + "\n" + passage) for k in range(24)])
    got = {r.doc_id: r.text for r in unitdedup.remove_repeats(docs).collect()}
    assert [k for k in range(24) if passage in got[k]] == [0] and len(got) == 24


def test_classes_keep_their_documents_when_later_scans_are_split_otherwise(spark, tmp_path, moving_splits):
    docs = scattered(spark, tmp_path, [(k, cases.prose(k % 12, 60) + " end" * (k // 12)) for k in range(24)])
    kept = {r.doc_id: r.text for r in ordermin.first_of_each_class(docs).collect()}
    assert kept == {k: cases.prose(k, 60) for k in range(12)}


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.components(chain).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_order_matters_to_a_sketch():
    words = np.arange(1, 401, dtype=np.uint64) * np.uint64(7919)
    same = sum(a == b for a, b in zip(ordermin.sketches(words), ordermin.sketches(words.copy()), strict=True))
    swapped = sum(a == b for a, b in zip(ordermin.sketches(words), ordermin.sketches(np.concatenate([words[200:], words[:200]])), strict=True))
    assert same == ordermin.SKETCHES and swapped <= ordermin.SKETCHES // 3


def removed_by_hand(rows, min_words=12):
    """{row: (text, spans)} by one pass over all units in order of id."""
    seen, out = set(), {}
    for d, text in sorted(((d, t) for d, t in rows), key=lambda r: (r[0] is None, r[0])):
        later = set()
        for k, (_, _, _, digest) in enumerate(unitdedup.units(text or "", "sentence")):
            if digest in seen:
                later.add(k)
            seen.add(digest)
        out[d] = unitdedup.removed_spans(unitdedup.units(text, "sentence"), later, min_words) if text else []
    return out


def test_query_repeats(spark):
    docs = cases.table("0.001", "documents")
    want = removed_by_hand(zip(docs.doc_id, docs.text, strict=True))
    got = {r.doc_id: r for r in queries.op9_unit_hash_dedup(spark, SF).collect()}
    assert {d: r.removed_spans for d, r in got.items()} == {d: ",".join(f"{a}:{b}" for a, b in s) for d, s in want.items()}
    assert any(want.values())


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_a_passage_goes_but_for_its_first_place(spark, tmp_path, unit):
    passage = cases.prose(90, 120)
    join = {"line": "\n", "paragraph": "\n\n", "sentence": " "}[unit]
    texts = [join.join([cases.prose(k, 70) + " " + cases.prose(k + 200, 6).rstrip("."), passage, cases.prose(k + 50, 40)]) for k in range(6)]
    rows = [(k, t, None) for k, t in enumerate(texts)] + [(9, None, "x"), (10, "", "x"), (11, cases.prose(77, 5000), "x"), (None, passage, "x")]
    docs = cases.stored(spark.createDataFrame(rows, "doc_id long, text string, repeats string"), tmp_path)
    got = {r.doc_id: r for r in unitdedup.remove_repeats(docs, unit=unit).collect()}
    assert len(got) == len(rows) and got[0].text == texts[0] and got[9].text is None and got[10].text == "" and got[11].text == rows[8][1] and not got[None].text
    for k in range(1, 6):
        assert got[k].text.split() == (texts[k].replace(passage, "")).split()
        assert [texts[k][s.start : s.end] for s in got[k].repeats.spans] == [passage]
    assert unitdedup.remove_repeats(docs.limit(0)).count() == 0


def test_short_common_phrases_stay(spark, tmp_path):
    rows = [(k, f"{cases.prose(k, 30)}\nReleased under the MIT License.\n{cases.prose(k + 99, 30)}") for k in range(5)]
    docs = cases.stored(spark.createDataFrame(rows, "doc_id long, text string"), tmp_path)
    assert {r.doc_id: r.text for r in unitdedup.remove_repeats(docs).collect()} == dict(rows)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "quality rules", "MinHash near-dedup", "substring dedup", "packing"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {d for d, t in texts.items() if len(t.split()) >= 50}
    first = stages["language ID"](spark, docs, SF)
    assert first.columns == docs.columns and len(good - {r.doc_id for r in first.collect()}) <= 1
    kept = stages["quality rules"](spark, docs, SF)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= good
    cleaned = stages["substring dedup"](spark, docs, SF)
    assert cleaned.columns == docs.columns and all(r.n_chars == len(r.text) and re.search(r"\S", r.text) for r in cleaned.collect())
    assert cleaned.schema == docs.schema


def test_pipeline_runs_to_the_end(spark):
    packed = corpus_pipeline.run(spark, SF).collect()
    assert packed and all(p.offset + p.length <= 2048 for p in packed)
