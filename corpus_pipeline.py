"""The corpus pipeline: quality filter, exact and near de-duplication, private data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame over all rows its predecessor kept; its result is
written as parquet under the shared folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from visitlens.llm import exact_dedup, packing, pii, quality, simhash
from visitlens.llm.common import document_batches
from visitlens.operators.materialize import materialize
from visitlens.sources.files import read_table


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier rejects (score below its threshold) go."""
    document_batches(spark)
    model = quality.fit(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.keep_good(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of equal texts the document with the largest id stays."""
    document_batches(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the document with the smallest id of each class stays."""
    document_batches(spark)
    return simhash.drop_near_dups(docs)


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: private data gives way to surrogates."""
    document_batches(spark)
    return pii.replace_private_data(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: every piece's place in a sequence of at most 2048 tokens."""
    document_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_good_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("pii", replace_private_data),
    ("packing", pack_sequences),
]

#: No stage but exact de-duplication is within SQL's reach; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
