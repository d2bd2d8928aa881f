"""The training-data pipeline: documents go through the stages in order.

Every stage gets what the one before kept, as written Parquet. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import bpe_codec, jaccard_join, language_id, mixing, secrets
from tollgate.llm.common import stored, table
from tollgate.llm.queries import WORD_TOKENIZER

#: Near duplicates of the pipeline: five-word shingles at 80 %. The four words and 85 % of op6 are that query's own.
NEAR = jaccard_join.Join(shingle=5, percent=80)


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: no text, no letters, or far from every language learned."""
    return language_id.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the one with the smallest id."""
    return jaccard_join.one_of_each(docs, NEAR)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays."""
    return secrets.redact(docs, secrets.new_ledger(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: a row per document and epoch with the words taken."""
    return mixing.mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded tokens."""
    return bpe_codec.round_trip(docs, public_tokenizers.path(WORD_TOKENIZER), keep_ids=True)


STAGES = [
    ("language_filter", language_filter), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan),
    ("source_mixing", source_mixing), ("bpe_encoding", bpe_encoding),
]

#: The first stage learns a classifier, which SQL cannot express; a test compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
