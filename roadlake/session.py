"""Session set-up and the two run-time checks every plan shares: where lineage is cut, and what may be broadcast."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "roadlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, adaptive execution, skew-join splitting)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Only a local master may go without: its executors are this machine."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {sc.master} share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the checkpoint folder, so that plans which use it twice compute it once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_bounded(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only when the optimizer's size estimate is under `max_bytes`; otherwise leave the
    join to Catalyst, which shuffles both sides (and splits skewed partitions under AQE)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df


def broadcast_if_measured(df: DataFrame, row_bytes: Column, max_bytes: int = 64 << 20) -> DataFrame:
    """`df`, written once, with a broadcast hint only if the sum of `row_bytes` over its rows is under `max_bytes`. For
    tables of lists, whose size the optimizer's estimate does not see."""
    df = cut_lineage(df)
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by `keys` into the session's number of shuffle partitions. Said explicitly, because adaptive
    execution merges partitions by bytes, and for work done in Python the bytes do not tell the cost."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
