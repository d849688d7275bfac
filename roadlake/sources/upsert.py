"""Keyed upsert under three policies: replace, keep known columns, guarded by a count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.session import cut_lineage


def merge(
    old: DataFrame, new: DataFrame, keys: list[str], order: list[str], keep_known: tuple[str, ...] = (), guard: str | None = None
) -> DataFrame:
    """The table after `new` is written over `old`, rows of `new` in `order` of arrival.

    Without options the latest row replaces the key. `keep_known` columns take the latest non-null value instead.
    With `guard`, a row replaces the key only when its guard is at least the present one: the greatest guard wins, the
    latest among equals. One grouping decides everything, and only one row per key and task is shuffled."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    position = F.struct(*([guard] if guard else []), "_new", *order)
    values = [c for c in old.columns if c not in keys]
    plain = [c for c in values if c not in keep_known]
    merged = both.groupBy(*keys).agg(
        F.max_by(F.struct(*plain), position).alias("_row"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in keep_known],
    )
    return merged.select(*keys, *[F.col(c) if c in keep_known else F.col("_row")[c].alias(c) for c in values])


MOST_TOUCHED = 1_000


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def existing(spark: SparkSession, path: str, new: DataFrame, partition: str) -> DataFrame:
    """The rows of the table's partitions that `new` touches; none where there is no table yet."""
    if not exists(spark, path):
        return new.limit(0)
    table = spark.read.schema(new.schema).parquet(path)
    touched = new.select(partition).distinct()
    values = [r[0] for r in touched.limit(MOST_TOUCHED + 1).collect()]
    if len(values) > MOST_TOUCHED:
        return table.join(touched.where(F.col(partition).isNotNull()), partition, "left_semi").select(*new.columns)
    known = F.col(partition).isin([v for v in values if v is not None])
    return table.where(known | F.col(partition).isNull() if None in values else known).select(*new.columns)


def upsert_parquet(path: str, new: DataFrame, keys: list[str], order: list[str], partition: str, **policy) -> None:
    """Merge `new` into the partitions of a Parquet table that it touches, and rewrite only those.

    The merged rows are checkpointed first, so the overwrite never reads what it replaces and a lost executor does
    not force a read of a half-written partition. The touched partition values are few and become literals, so that
    the scan lists and reads no other partition; above MOST_TOUCHED of them the same rows are found by a join."""
    spark = new.sparkSession
    new = cut_lineage(new)
    old = existing(spark, path, new, partition)
    merged = cut_lineage(merge(old, new, keys, order, **policy))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], partition: str, **policy):
    """A streaming query that upserts every micro-batch; replaying a batch gives the same table."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, _: upsert_parquet(path, batch, keys, order, partition, **policy)
    )
