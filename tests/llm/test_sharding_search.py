import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from roadlake.llm import crosspolytope, queries, sharding

SF = "/root/testdata/sf0.001"


def split_by_hand(rows, shards):
    """Sizes of shards when every node is cut at the nearest weighted place along its widest dimension (ids here)."""
    rows = sorted(rows)
    if shards == 1:
        return [sum(s for _, s in rows)]
    left = shards // 2
    target = sum(s for _, s in rows) * left / shards
    sums = np.concatenate([[0], np.cumsum([s for _, s in rows])])
    at = int(np.abs(sums - target).argmin())
    return split_by_hand(rows[:at], left) + split_by_hand(rows[at:], shards - left)


def test_shards_of_one_dimension_equal_those_by_hand(spark):
    got = sharding.kd_shards(spark.read.parquet(f"{SF}/documents.parquet"), shards=6, dimensions=["doc_id"]).toPandas()
    want = split_by_hand(list(zip(got.doc_id, got["size"], strict=True)), 6)
    assert got.groupby("shard")["size"].sum().tolist() == want


def test_query_shards(spark):
    got = queries.op1_kd_sharding(spark, SF).toPandas()
    docs = cases.table("0.001", "documents").set_index("doc_id").text
    assert sorted(got.doc_id) == sorted(docs.index) and set(got.shard) == set(range(24))
    for r in got.itertuples():
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= 2 * got["size"].max()


def test_shards_of_awkward_rows(spark, tmp_path):
    docs = cases.stored(cases.awkward(spark), tmp_path)
    got = sharding.kd_shards(docs, shards=3, dimensions=["doc_id", "lang", "source", "n_chars", "kept"]).collect()
    assert len(got) == docs.count()
    assert {r["size"] for r in got if r.doc_id in (0, 1)} == {8} and {r.text_crc32 for r in got if r.doc_id in (0, 1)} == {0}
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(3) for k in range(sum(r.shard == s for r in got))]
    assert sharding.kd_shards(docs.limit(0), shards=3).count() == 0


def test_repeated_rows_are_spread(spark, tmp_path):
    docs = cases.stored(spark.createDataFrame([(1, "same text", "en", "s")] * 400, "doc_id long, text string, lang string, source string"), tmp_path)
    sizes = [r["count"] for r in sharding.kd_shards(docs, shards=4).groupBy("shard").count().collect()]
    assert sum(sizes) == 400 and max(sizes) - min(sizes) <= 3


def test_leaves_of_a_target_size(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [r["s"] for r in sharding.kd_shards(docs, target_bytes=100_000).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == -(-sum(sizes) // 100_000)


def nearest(table, neighbours):
    ids, x = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), np.float64)
    scores = x @ x.T
    out = {}
    for k in np.flatnonzero(ids % 20 == 0):
        order = [i for i in np.lexsort([ids, -scores[k]]) if ids[i] != ids[k]][:neighbours]
        out[int(ids[k])] = [int(ids[i]) for i in order]
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_recall(spark, sf):
    got = queries.op2_crosspolytope_search(spark, f"/root/testdata/sf{sf}").toPandas()
    want = nearest(cases.table(sf, "embeddings"), 20)
    found = got.sort_values("rank").groupby("query_id").vec_id.apply(list).to_dict()
    assert set(found) == set(want) and all(len(set(f)) == 20 for f in found.values())
    assert np.mean([len(set(found[q]) & set(want[q])) / 20 for q in want]) >= 0.9
    ranked = got.sort_values(["query_id", "rank"])
    assert (ranked.groupby("query_id").score.diff().dropna() <= 0).all()


@pytest.mark.parametrize("lengths", ["one long", "spread", "just unequal", "wide"])
def test_recall_of_vectors_of_other_lengths(spark, lengths):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 80 if lengths == "wide" else 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths == "one long":
        x[3] *= 1000
    elif lengths == "spread":
        x *= rng.lognormal(0, 0.7, (1500, 1))
    elif lengths == "just unequal":
        x[5] *= 0.99
    table = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = crosspolytope.crosspolytope_neighbours(table, F.col("vec_id") % 20 == 0).toPandas()
    want = nearest(table.toPandas(), 20)
    found = got.sort_values("rank").groupby("query_id").vec_id.apply(list).to_dict()
    assert set(found) == set(want) and all(len(set(f)) == 20 for f in found.values())
    assert np.mean([len(set(found[q]) & set(want[q])) / 20 for q in want]) >= 0.9


def test_queries_that_find_too_few_are_compared_with_all(spark):
    x = np.random.default_rng(9).normal(size=(60, 64))
    table = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = crosspolytope.crosspolytope_neighbours(table, F.col("vec_id") % 20 == 0, tables=1, probes=2).toPandas()
    assert got.sort_values("rank").groupby("query_id").vec_id.apply(list).to_dict() == nearest(table.toPandas(), 20)


def test_all_probes_give_the_exact_answer_with_ties_copies_and_lengths(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 5)) * rng.uniform(0.2, 3, (90, 1))
    x[10:50] = x[0]
    rows = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]
    good = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    bad = spark.createDataFrame([(100, None), (120, []), (140, [0.0] * 5), (160, [1.0, None, 0.0, 0.0, 0.0]), (180, [float("nan")] * 5), (200, [float("inf")] * 5), (None, [1.0] * 5)], good.schema)
    got = crosspolytope.crosspolytope_neighbours(good.union(bad).union(good.limit(3)), F.col("vec_id") % 20 == 0, neighbours=7, probes=16).toPandas()
    want = nearest(good.toPandas(), 7)
    assert got.sort_values("rank").groupby("query_id").vec_id.apply(list).to_dict() == want
    assert crosspolytope.crosspolytope_neighbours(good.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert crosspolytope.crosspolytope_neighbours(good.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_transform_is_orthogonal_and_own_inverse():
    x = np.random.default_rng(1).normal(size=(4, 16))
    assert np.allclose(crosspolytope.hadamard(crosspolytope.hadamard(x)), x)
    for rows in crosspolytope.turned(x, 3, 5):
        assert np.allclose(np.linalg.norm(rows, axis=1), np.linalg.norm(x, axis=1))
