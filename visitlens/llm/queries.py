"""The registered queries ``op1_`` to ``op13_`` over their whole tables (``documents``, for op12 also ``benchmark``, for op13
``embeddings``), with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import read_table
from . import (bpe, chunk_prints, exact_dedup, jaccard_join, licenses, line_dedup, packing, pii, quality, resampling, sharding, simhash,
               whitening)
from .common import document_batches

SHARDS = 40


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    document_batches(spark)
    return read_table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def op1_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dups(_documents(spark, sf_dir))


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(_documents(spark, sf_dir, "lang", "source"), SHARDS)


def op3_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_private_data(_documents(spark, sf_dir), report=True)


def op5_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_prints.edited_fingerprints(_documents(spark, sf_dir))


def op6_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    model = quality.fit(documents, read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.score_documents(documents, model)


def op7_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op9_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir))


def op10_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_documents(spark, sf_dir)).withColumn(
        "text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))


def op11_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(_documents(spark, sf_dir))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark").select("text"))


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dups, op2_hilbert_shards, op3_exact_duplicates, op4_pii_surrogates, op5_chunk_fingerprints,
    op6_quality_scores, op7_best_two_fit, op8_rank_queue_bpe, op9_license_templates, op10_line_windows, op11_jaccard_regions,
    op12_importance_resampling, op13_feast_whitening)}
