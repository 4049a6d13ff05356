"""The queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, licenses, linededup, lm, media, quality, simhash, suffix, tokencount, trie, urlfilter, whiten
from tidemark.llm.work import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUALITY_THRESHOLD = 0.3


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(media.describe(media.store(table(spark, sf_dir, "documents"))))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it leaks; clean documents have none."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=4, shingle=4)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    predicted = F.when(F.col("score") >= QUALITY_THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"), "n_lines", "n_good_lines")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix.dedup_substrings(table(spark, sf_dir, "documents"), least=20)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urlfilter.train(urlfilter.labelled(spark))
    return urlfilter.judge(table(spark, sf_dir, "pages"), model)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"), components=4)


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(licenses.scan(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_media, op3_decontamination, op4_simhash, op5_quality, op6_substring_dedup, op7_language_model, op8_token_counts, op9_line_dedup, op10_url_filter, op11_prefix_trie, op12_whitening, op13_licenses)}
ORACLES = {"op6_substring_dedup": suffix.ORACLE, "op9_line_dedup": linededup.ORACLE, "op11_prefix_trie": trie.ORACLE}
