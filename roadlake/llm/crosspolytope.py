"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

A table turns a unit vector by three rounds of random signs and a fast Hadamard transform and takes the signed axis that
it is nearest to. Candidates lie in one bucket of every table; a query looks into the buckets of the axes it is nearest
to. Candidates and queries of a bucket meet in one task, in blocks of bounded size, where the inner products are taken
in double precision and each query keeps its best; the best of all blocks are then merged.

Directions are hashed, so candidates are told apart by length first: those within about a fifth of a length form a band with
buckets of its own, and a query looks into the same axes of every band. A query that finds too few is compared with all.

Equal vectors count as one candidate that carries its smallest ids, so copies are never compared with each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake.session import cut_lineage

BLOCK = 4096  # candidates, or queries, of a bucket that meet in one task
BANDS = 4  # of length, for each factor of two
SHARE = 24 / 128  # of a table's axes that are probed at least; padding to a power of two does not thin the probes out


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, in n log n steps; the length is a power of two."""
    n, width = rows.shape[1], 1
    while width < n:
        pairs = rows.reshape(len(rows), n // (2 * width), 2, width)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), n)
        width *= 2
    return rows / np.sqrt(n)


def turned(vectors: np.ndarray, tables: int, seed: int) -> Iterator[np.ndarray]:
    """For each table, the vectors after its pseudo-rotation, padded to a power of two."""
    n, dim = vectors.shape
    size = 1 << max(0, (dim - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :dim] = vectors
    for table in range(tables):
        signs = np.random.default_rng([seed, table, size]).choice([-1.0, 1.0], (3, size))
        rows = padded
        for sign in signs:
            rows = hadamard(rows * sign)
        yield rows


def buckets(vectors: np.ndarray, tables: int, probes: int, seed: int) -> np.ndarray:
    """One row per vector: for every table the `probes` nearest signed axes, or SHARE of them if that is more (one: the nearest), as numbers table * 2 * size + axis."""
    out = []
    for table, rows in enumerate(turned(vectors, tables, seed)):
        size = rows.shape[1]
        probes = max(probes, math.ceil(SHARE * 2 * size)) if probes > 1 else probes
        axes = np.concatenate([rows, -rows], axis=1)
        best = np.argpartition(-axes, min(probes, 2 * size) - 1, axis=1)[:, :probes] if probes > 1 else np.argmax(axes, axis=1)[:, None]
        out.append(table * 2 * size + best)
    return np.concatenate(out, axis=1)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def hasher(tables: int, probes: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds `buckets`, those of the direction, to rows of (vector, dim, ...)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                vectors = matrix(rows.column("vector"))
                vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
                vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                numbers = buckets(vectors, tables, probes, seed)
                found = pa.ListArray.from_arrays(pa.array(np.arange(0, numbers.size + 1, numbers.shape[1]), pa.int32()), pa.array(numbers.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([*rows.columns, found], names=[*rows.schema.names, "buckets"])

    return run


def rerank(neighbours: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For a block of candidates and one of queries: each query's `neighbours` best ids by inner product, ties included."""
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not candidates.num_rows or not queries.num_rows:
            return empty
        c, q = matrix(candidates.column("vector")), matrix(queries.column("vector"))
        scores = q @ c.T
        if len(c) > neighbours:  # a margin for the rounding of the product; the score proper is taken below
            least = np.partition(scores, len(c) - neighbours, axis=1)[:, len(c) - neighbours, None]
            qi, ci = np.nonzero(scores >= least - 1e-9 * np.abs(least) - 1e-12)
        else:
            qi, ci = (x.ravel() for x in np.indices(scores.shape))
        exact = np.einsum("ij,ij->i", q[qi], c[ci])
        ids = candidates.column("ids").combine_chunks()
        counts = ids.value_lengths().to_numpy(zero_copy_only=False)[ci]
        starts = ids.offsets.to_numpy()[ci] - ids.offsets.to_numpy()[0]
        at = np.repeat(np.arange(len(ci)), counts)
        member = starts[at] + np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        vec, row, score = ids.flatten().to_numpy(zero_copy_only=False)[member], qi[at], exact[at]
        order = np.lexsort([vec, -score, row])
        row, vec, score = row[order], vec[order], score[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < neighbours
        return pa.table({"query": queries.column("query").combine_chunks().take(pa.array(row[keep])), "vec_id": pa.array(vec[keep], pa.int64()), "score": pa.array(score[keep], pa.float64())})

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, dim) of the vectors that take part: no null, no zero vector, finite components only."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector")).where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).withColumn("dim", F.size(v))


def met(candidates: DataFrame, queries: DataFrame, key: list[str], take: int) -> DataFrame:
    """(query, vec_id, score): each query's best of every block of candidates with the same `key`. Both carry `parts` and
    `turns`, the numbers of blocks of candidates and of queries."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = [*key, "part", "turn"]
    candidates = candidates.withColumn("part", F.pmod(F.xxhash64("vector"), "parts").cast("int")).withColumn("turn", every("turns")).select(*block, "vector", "ids")
    queries = queries.withColumn("turn", F.pmod(F.xxhash64("query"), "turns").cast("int")).withColumn("part", every("parts")).select(*block, "vector", "query")
    return candidates.groupBy(*block).cogroup(queries.groupBy(*block)).applyInArrow(rerank(take), "query long, vec_id long, score double")


def crosspolytope_neighbours(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", neighbours: int = 20, tables: int = 8, probes: int = 24, seed: int = 11,
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest vectors found for every row for which `is_query` holds.

    `is_query` is a condition on the column vec_id. Each query looks into `probes` buckets of each of `tables` tables
    over all rows; crowded buckets are split into blocks, by counts that are one row per bucket. Nearness is the inner
    product; ties go to the smaller id. A query whose buckets hold too few candidates is compared with all vectors, so fewer
    rows than `neighbours` come back only where there are no more vectors of its length.

    Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do rows without an id.
    Vectors of other lengths are other spaces. Rows repeated with the same id count once and are never their own
    neighbours; equal vectors with other ids are neighbours. An empty table gives an empty result.
    """
    take = neighbours + 1  # a query may find itself
    rows = usable(vectors, id_col, vector_col)
    smallest = F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = rows.withColumn("n", smallest).where(F.col("n") <= take).groupBy("vector", "dim").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    asked = rows.where(is_query)
    classes = asked.groupBy("vector", "dim").agg(F.min("vec_id").alias("query"))
    peak = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    log = F.log2(peak) + F.log2(F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x.cast("double") / peak) * (x.cast("double") / peak))) / 2
    distinct = distinct.withColumn("log", log)
    longest = distinct.agg(F.max("log")).first()[0] or 0.0
    distinct = distinct.select("vector", "dim", "ids", F.round((F.lit(longest) - F.col("log")) * BANDS).cast("int").alias("band"))  # equal lengths: all in band 0
    kind = vectors.schema[vector_col].dataType.simpleString()
    index = cut_lineage(distinct.mapInArrow(hasher(tables, 1, seed), f"vector {kind}, dim int, ids array<long>, band int, buckets array<int>"))
    probing = cut_lineage(classes.mapInArrow(hasher(tables, probes, seed), f"vector {kind}, dim int, query long, buckets array<int>"))

    # blocks by band and bucket: at most tables * 2 * size rows for each band of each length of vector
    sizes = lambda df, name, *key: df.select("dim", *key, F.explode("buckets").alias("bucket")).groupBy("dim", *key, "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    blocks = sizes(index, "parts", "band").join(sizes(probing, "turns"), ["dim", "bucket"])
    blocks = blocks.select(*(F.col(c).alias(c) for c in blocks.columns))  # columns of its own, since it is joined to both sides
    candidates = index.select("vector", "dim", "ids", "band", F.explode("buckets").alias("bucket")).join(F.broadcast(blocks), ["dim", "band", "bucket"])
    queries = probing.select("vector", "dim", "query", F.explode("buckets").alias("bucket")).join(F.broadcast(blocks), ["dim", "bucket"])
    best = cut_lineage(met(candidates, queries, ["dim", "band", "bucket"], take))

    # queries that have found too few: against all vectors of their length
    there = index.groupBy("dim").agg(F.sum(F.size("ids")).alias("there"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    found = best.groupBy("query").agg(F.count_distinct("vec_id").alias("found"))
    short = probing.select("vector", "dim", "query").join(found, "query", "left").join(F.broadcast(there), "dim").where(F.coalesce("found", F.lit(0)) < F.least("there", F.lit(take)))
    short = cut_lineage(short.select("vector", "dim", "query"))
    if not short.isEmpty():
        blocks = there.select("dim", "parts").join(short.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("turns")), "dim")
        best = best.union(met(index.select("vector", "dim", "ids").join(F.broadcast(blocks), "dim"), short.join(F.broadcast(blocks), "dim"), ["dim"], take))

    nearest = F.dense_rank().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    lists = best.withColumn("n", nearest).where(F.col("n") <= take).groupBy("query").agg(F.sort_array(F.collect_set(F.struct("n", "vec_id", "score"))).alias("found"))
    members = asked.select(F.col("vec_id").alias("query_id"), "vector", "dim").distinct().join(classes, ["vector", "dim"]).select("query_id", "query")
    own = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, neighbours)
    return members.join(lists, "query").select("query_id", F.posexplode(own).alias("at", "near")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("near.vec_id").alias("vec_id"), F.col("near.score").alias("score"))
