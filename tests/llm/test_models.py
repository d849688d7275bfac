import itertools
import zlib

import numpy as np
import pytest

import cases
from roadlake.llm import bytegru, languages, queries, toxicity

SF = "/root/testdata/sf0.1"


def test_gradients():
    rng = np.random.default_rng(0)
    net, windows, labels = bytegru.fresh(3, 4, 1), rng.integers(0, 256, (5, 7)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = bytegru.gradients(net, windows, labels)
    for w, g in zip(bytegru.flat(net), bytegru.flat(grads), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        held, w[at] = w[at], w[at] + 1e-6
        up = bytegru.gradients(net, windows, labels)[0]
        w[at] = held - 1e-6
        down = bytegru.gradients(net, windows, labels)[0]
        w[at] = held
        assert abs((up - down) / 2e-6 - g[at]) < 1e-6


def test_query_language_held_out(spark):
    got = queries.op8_byte_gru_language(spark, SF).toPandas()
    docs = cases.table("0.1", "documents").set_index("doc_id")
    assert sorted(got.doc_id) == sorted(docs.index)
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang_pred == docs.lang[held.doc_id].to_numpy()).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_of_awkward_rows(spark):
    docs = cases.awkward(spark)
    model = languages.Model(["aa", "bb"], bytegru.fresh(2, 4, 3))
    got = [(r.doc_id, r.lang_pred, r.score) for r in languages.identify(docs, model).collect()]
    assert len(got) == docs.count()
    assert {d for d, lang, score in got if lang == "und" and score == 0} == {0, 1, 2}
    assert {lang for d, lang, _ in got if d not in (0, 1, 2)} <= {"aa", "bb"}
    assert languages.identify(docs.limit(0), model).count() == 0
    kept = languages.identify(docs, model, keep=tuple(docs.columns))
    assert kept.columns == ["doc_id", "lang_pred", "score", *(f"kept_{k}" for k in range(len(docs.columns)))]
    nothing = languages.fit(docs.where("false"))
    assert {r.lang_pred for r in languages.identify(docs, nothing).collect()} == {"und"}


def test_every_byte_of_a_long_text_counts():
    model = languages.Model(["a", "b"], bytegru.fresh(2, 4, 3))
    text = np.frombuffer(cases.prose(1, 3000).encode(), np.uint8)
    whole = model.pooled(text, np.array([0, len(text)]))[0]
    sums, n = np.zeros(2), 0
    for k in range(0, len(text), languages.WIDTH):
        part = text[k : k + languages.WIDTH]
        p = bytegru.label_positions(model.network, part[None, :])[:, 0]
        inside = languages.LETTER_BYTES[part]
        if len(part) == languages.WIDTH:
            sums, n = sums + p[inside].sum(axis=0), n + inside.sum()
    assert np.allclose(whole, sums / n, atol=0.01)


def test_query_toxicity_held_out(spark):
    got = queries.op6_folded_lexicon(spark, SF).toPandas()
    docs, labels = cases.table("0.1", "documents"), cases.table("0.1", "labels").set_index("doc_id").toxic
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out & got.doc_id.isin(labels.index)]
    truth = labels[held.doc_id].to_numpy()
    assert held.predicted[truth == 1].mean() > 0.75 and held.predicted[truth == 0].mean() < 0.02


LEXICON = toxicity.Lexicon({"idiot": 5.0, "lose": 3.0, "loser": 6.0}, frozenset([("the", "lose")]), -3.0, (1.0, 1.0))


@pytest.mark.parametrize("text, weight", [
    ("an idiot", 5.0), ("an ID1OT!", 5.0), ("іdіоt", 5.0), ("idiots", 5.0), ("anidiot", 0.0), ("a l0ser", 6.0), ("10ser", 6.0), ("they lose it", 3.0), ("the lose end", 0.0), ("i​diot", 5.0), ("!!! 101", 0.0), ("", 0.0), ("ｉｄｉｏｔ", 5.0),
])
def test_folding_and_exceptions(text, weight):
    total, _ = toxicity.measured(toxicity.folded(text), toxicity.automaton(LEXICON.weights), LEXICON)
    assert total == weight


def test_toxicity_of_awkward_rows(spark):
    docs = cases.awkward(spark)
    got = toxicity.toxicity(docs, LEXICON).collect()
    assert len(got) == docs.count() and all(0 <= r.score < 0.3 for r in got)
    assert toxicity.toxicity(docs.limit(0), LEXICON).count() == 0
    nothing = toxicity.fit(spark.createDataFrame([], "doc_id long, text string, toxic int"))
    assert nothing.weights == {} and {r.matched_weight for r in toxicity.toxicity(docs, nothing).collect()} == {0.0}
    only = toxicity.fit(spark.createDataFrame([(1, None, 1), (2, "", 0), (3, "x", None), (1, "bad worse", 1)], "doc_id long, text string, toxic int"))
    assert isinstance(only, toxicity.Lexicon)


def test_sample_is_chosen_from_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "x", 5) for i in range(50)] + [(3, "again", "x", 5), (None, "none", "x", 5)], "doc_id long, text string, lang string, toxic int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(4, 1), (6, 0), (None, 1), (7, None), (8, 2)], "doc_id long, toxic int")
    rows = toxicity.sampled(docs, labels).collect()
    assert sorted((r.doc_id, r.toxic) for r in rows) == sorted([(i, 1 if i == 4 else i % 2) for i in range(50)] + [(3, 1)])
    assert 0 < toxicity.sampled(docs, labels, 10, 10).count() < 40
    assert toxicity.sampled(docs, labels.limit(0)).count() == 0


def test_no_term_is_cut(spark):
    """Five thousand words, each in six of sixty toxic texts, are five thousand terms."""
    letters = "bcdfghjkmn"
    terms = ["".join(p) for p in itertools.product(letters, repeat=4)][:5000]
    texts = [[] for _ in range(60)]
    for k, t in enumerate(terms):
        for j in range(6):
            texts[(k * 7 + j * 11) % 60].append(t + "q")
    rows = [(i, " ".join(t), 1) for i, t in enumerate(texts)] + [(100 + i, f"other words of text {i} zzz{i}", 0) for i in range(400)]
    found = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert set(found.weights) == set(terms)
