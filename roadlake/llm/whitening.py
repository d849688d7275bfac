"""Whitening of embeddings from a covariance weighted by multiplicity.

Entries become whole numbers x. Equal x vectors are one row with their count; sums, covariance and the whitened values are
computed once for each of them, the fit weighted by the count or by one, and joined back to the rows. Sums are exact and
every vector is centred exactly before the products. Tasks send d sums and d x d products, d the vectors' length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**52  # beyond it x is no long
HOT = 1000  # an x vector on more than this part of all rows is hot; so at most that many are, and they are broadcast
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def grid(vector: Column) -> Column:
    """Each entry c as floor(1024 c) + 100000; null where that is no long, for a filter may be evaluated after it."""
    return F.transform(vector, lambda c: F.when(F.abs(c.cast("double")) < LARGEST, F.floor(c.cast("double") * SCALE) + SHIFT))


def usable(vector: Column) -> Column:
    """Vectors with at least one entry, all of them numbers. NaN counts as larger than any number."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))


def matrix(column: pa.Array, dtype: type) -> np.ndarray:
    """An array column of equal lengths as a matrix."""
    return np.asarray(column.flatten()).astype(dtype, copy=False).reshape(len(column), -1)


def totals(rows: DataFrame, column: str, per_batch: Callable[[np.ndarray, np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum of `per_batch(matrix, weights)` over all rows. A task adds up its batches, Spark the tasks, entry by entry."""
    dtype = np.int64 if kind == "long" else np.float64

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = per_batch(matrix(batch.column(column), np.int64 if column == "x" else np.float64), batch.column("weight").to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.ravel().tolist()], pa.list_(pa.int64() if kind == "long" else pa.float64()))})

    sums = rows.select(column, "weight").mapInArrow(partial, f"sums array<{kind}>")
    added = sums.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("sum")).orderBy("pos").collect()
    return np.array([r["sum"] for r in added], dtype)


def covariance(rows: DataFrame, column: str, n: int, centre: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    def products(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
        centred = centre(values)
        return (centred * weights[:, None]).T @ centred

    flat = totals(rows, column, products, "double")
    d = int(len(flat) ** 0.5)
    return flat.reshape(d, d) / n


def axes(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, whose entry of largest size is positive. Directions
    in which the vectors do not vary, but for rounding, are left out."""
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(values.max(), 0) * len(cov) * np.finfo(float).eps]
    vectors = vectors[:, order]
    return values[order], vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8, counted: bool = True) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error, a row for every usable vector and
    component.

    The fit takes each distinct x vector as often as it occurs, or once if not `counted`; n, sums and covariances are those
    of that fit list. `deviation` is the exact sum over dimensions of (n x - S) squared; beyond a long the job fails.
    `explained` is the eigenvalue's share of the trace, `identity_error` the largest entry, by size, of the fit list's
    whitened covariance minus the identity.

    Vectors that are null, empty or hold an entry that is null, NaN, infinite or 2^52 and more do not take part; nor do vectors of another length
    than most of them have (of equally frequent lengths the longer). Repeated rows count and are returned each, a null id
    stays null. Equal eigenvalues leave their axes to chance, components without variance are not returned, so vectors
    that are all equal, or an empty table, give an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v")).where(usable(F.col("v"))).select("vec_id", grid(F.col("v")).alias("x"))
    distinct = common.written(rows.groupBy("x").agg(F.count("*").alias("copies")).withColumn("weight", F.col("copies") if counted else F.lit(1).cast("long")))
    lengths = distinct.groupBy(F.size("x").alias("length")).agg(F.sum("copies").alias("n"), F.sum("weight").alias("fit"))
    top = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if top is None:
        return spark.createDataFrame([], RESULT)
    length, rows_n, n = top
    fitted = distinct.where(F.size("x") == length)
    sums = totals(fitted, "x", lambda x, w: w @ x, "long")
    cov = covariance(fitted, "x", n, lambda x: (n * x - sums) / n)
    values, vectors_ = axes(cov, components)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    turn, explained = vectors_ / np.sqrt(values), (values / np.trace(cov)).tolist()

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                off = n * matrix(batch.column("x"), np.int64) - sums
                if (np.square(off.astype(float)).sum(axis=1) >= 2.0**63).any():
                    raise OverflowError("a deviation is beyond a long")
                whitened = pa.FixedSizeListArray.from_arrays(pa.array(((off / n) @ turn).ravel()), len(values)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("copies"), batch.column("weight"), pa.array(np.square(off).sum(axis=1)), whitened], names=["x", "copies", "weight", "deviation", "whitened"])

    done = common.written(fitted.mapInArrow(turned, "x array<long>, copies long, weight long, deviation long, whitened array<double>"))
    mean = totals(done, "whitened", lambda y, w: w @ y, "double") / n
    error = float(np.abs(covariance(done, "whitened", n, lambda y: y - mean) - np.eye(len(values))).max())
    hot = F.broadcast(done.where(F.col("copies") * HOT > rows_n).select("x", "deviation", "whitened"))
    rest = rows.where(F.size("x") == length).join(hot.select("x"), "x", "left_anti").join(done.where(F.col("copies") * HOT <= rows_n).select("x", "deviation", "whitened"), "x")
    joined = rows.join(hot, "x").unionByName(rest).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.element_at(F.array(*map(F.lit, explained)), F.col("at") + 1)
    return joined.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
