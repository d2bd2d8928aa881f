"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import (
    bpe_codec, fingerprint, hmm, jaccard_join, language_id, mixing, oracle, piece_codec, prefix_trie, quality, runs, secrets,
    token_counts, warc,
)
from tollgate.llm.common import table

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


def op3_hidden_markov_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(table(spark, sf_dir, "documents"))


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = warc.new_archive(pages)
    warc.write_archive(pages, archive)
    return warc.read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_TOKENIZER))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.new_ledger(docs))

    def of(kinds: list[str]):
        return F.filter("findings", lambda s: s["kind"].isin(kinds))

    counts = [F.size(of([kind])).cast("bigint").alias(f"n_{kind}") for kind in secrets.BASE]
    base = F.sha2(secrets.span_list(of(secrets.BASE)), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), secrets.span_list(F.col("findings")).alias("spans"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build_trie(table(spark, sf_dir, "conversations"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(table(spark, sf_dir, "documents"), planted=True)
    best = runs.longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), "collapsed_sha256")


def op13_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECE_TOKENIZER)
    encoded = piece_codec.encode_documents(table(spark, sf_dir, "documents"), model)
    return piece_codec.decode_documents(encoded, model).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_source_mixing, op2_quality_rules, op3_hidden_markov_model, op4_bpe_round_trip, op5_language_id,
        op6_jaccard_join, op7_warc_archive, op8_token_counts, op9_secret_scan, op10_fingerprints,
        op11_prefix_trie, op12_periodic_runs, op13_piece_round_trip)
}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
