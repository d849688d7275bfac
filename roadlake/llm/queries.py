"""The registered queries of the text operators: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytepair, common, crosspolytope, languages, licenses, linededup, ordermin, packing, repetition, sharding, tokenalign, toxicity, unitdedup, whitening

Query = Callable[[SparkSession, str], DataFrame]


def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.kd_shards(common.table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_crosspolytope_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.crosspolytope_neighbours(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, neighbours=20)


def op3_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_quality(common.table(spark, sf_dir, "documents")).drop("spans")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(common.table(spark, sf_dir, "documents")).drop("detections")


def op5_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepair.encode_corpus(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op6_folded_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "toxic").where(languages.remainder("doc_id", 4) != 2)
    scored = toxicity.toxicity(docs, toxicity.fit(toxicity.sampled(docs, labels)))
    return scored.select("doc_id", F.coalesce(languages.remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.near_duplicates(common.table(spark, sf_dir, "documents"))


def op8_byte_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = languages.fit(docs.where(languages.remainder("doc_id", 5) != 0))
    found = languages.identify(docs, model)
    return found.select("doc_id", F.coalesce(languages.remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_unit_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = unitdedup.remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.concat_ws(",", F.transform("repeats.spans", lambda s: F.concat_ws(":", s["start"], s["end"])))
    return found.select("doc_id", "text", "repeats.n_units", "repeats.n_removed", "repeats.removed_chars", spans.alias("removed_spans"))


def op10_dynamic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_shared_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.kept_text(linededup.line_bitmaps(common.table(spark, sf_dir, "documents"), min_documents=10, min_chars=1, keep_first=False))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op12_anchored_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenalign.align_corpus(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_multiplicity_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(common.table(spark, sf_dir, "embeddings"), components=8)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_kd_sharding, op2_crosspolytope_search, op3_suffix_repetition, op4_license_scan, op5_distinct_word_bpe, op6_folded_lexicon, op7_order_minhash, op8_byte_gru_language, op9_unit_hash_dedup, op10_dynamic_packing,
    op11_shared_line_dedup, op12_anchored_alignment, op13_multiplicity_whitening)}
CHECKS: dict[str, str] = {
    "op11_shared_line_dedup": """WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
    k AS (SELECT *, translate(trim(line, ' '||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    shared AS (SELECT key AS gone FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
    FROM k LEFT JOIN shared ON key = gone GROUP BY r, doc_id""",
}
