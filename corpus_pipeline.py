"""From documents to packed training sequences: five stages, each a text operator applied to what the one before it kept.

Every stage but the last returns the columns of documents; `run` writes each stage's rows as Parquet to the folder that
the cluster shares and reads them again, so that a lost executor costs a stage at most and each stage scans a table.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm import languages, ordermin, packing, repetition, unitdedup
from roadlake.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CERTAIN = 0.3  # of pooled probability: texts of mixed languages stay, what no language fits goes


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with some certainty; texts without a letter go. Columns pass through unchanged."""
    model = languages.fit(docs.where(languages.remainder("doc_id", 5) != 0))
    found = languages.identify(docs, model, keep=tuple(docs.columns))
    return found.where((F.col("lang_pred") != languages.UNKNOWN) & (F.col("score") >= CERTAIN)).select(*(F.col(f"kept_{k}").alias(c) for k, c in enumerate(docs.columns)))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the first of its smallest id."""
    return ordermin.first_of_each_class(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; those of which nothing is left go. n_chars follows the text."""
    cleaned = unitdedup.remove_repeats(docs).drop("repeats")
    left = cleaned.where(F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language ID", language_id), ("quality rules", quality_rules), ("MinHash near-dedup", near_duplicates), ("substring dedup", substring_dedup), ("packing", pack)]
ORACLE_SQL = None  # a trained network and alignments are beyond SQL; the tests hold each stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
