"""A training corpus from `documents`: quality, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read again as the next one's docs. All but the last return the columns
of documents.

1. quality: documents whose score is under 0.3 go.
2. line_dedup: later repeats of runs of two lines go; n_chars is counted anew; documents of which nothing is left go.
3. near_dedup: of documents whose sets of five-word shingles are 0.8 similar or more, the one with the smallest id stays, as far as fingerprints lie within 12 bits.
4. decontamination: documents that leak a benchmark item (0.8 or more) go.
5. bpe: the ids of what is left, and digests of them and of the bytes they decode to.

Nulls: a text that is null counts as empty. A row without doc_id is never compared with others, so stages 2 and 3 keep it. Different texts with one id are
judged each by itself; equal rows stay or go together.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, linededup, quality, simhash
from tidemark.llm.work import apart, table, written

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    left = linededup.dedup_lines(docs, carry=others)
    left = left.filter((F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0))
    values = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")} | {c: F.col("carried")[c] for c in others}
    return left.select(*[values[c].alias(c) for c in docs.columns])


def without(docs: DataFrame, found: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """docs without the rows whose ids are found; of different texts with one id, each is judged by itself."""
    own, back = apart(docs)
    return back(own.join(written(found(own), "dropped"), "doc_id", "left_anti")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, lambda own: simhash.drop_near_duplicates(own, radius=12, shingle=5, similarity=0.8))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, lambda own: decontam.find_leaks(own, table(spark, sf_dir, "benchmark")).select("doc_id").distinct())


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    return decoded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "token_ids")


STAGES = [("quality", good), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("bpe", tokens)]
#: The classifier is no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
