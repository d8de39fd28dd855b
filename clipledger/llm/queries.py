"""The operators of this subpackage over their whole tables, and expected results where SQL can state them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    near_duplicates,
    quality,
    records,
    runs,
    secrets,
    sharding,
    token_counts,
    toxicity,
    url_filter,
    warc,
)
from clipledger.llm.expected import ORACLES
from clipledger.llm.support import stage, tables

Query = Callable[[SparkSession, str], DataFrame]

#: The vocabulary: a rank file and the pattern that goes with it.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The id that ends every document of binary output.
END_ID = 2


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and its pattern. LLM_RANKS names another file than the public one."""
    import public_tokenizers

    return os.environ.get("LLM_RANKS") or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(tables(spark, sf_dir, "documents"), 16)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = vocabulary()
    return bpe.encode_digests(tables(spark, sf_dir, "documents"), path, pattern)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables(spark, sf_dir, "documents").select("doc_id", secrets.secret_spans(*vocabulary()).alias("s"))
    return found.select("doc_id", "s.n_assign", "s.n_access", "s.n_hex", "s.n_token", "s.base_sha256", "s.spans")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(tables(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(tables(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.link_documents(tables(spark, sf_dir, "documents"), counts=True)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(tables(spark, sf_dir, "documents"), *vocabulary())


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits pages as an archive against a replica that lost some records and in which others changed.

    Records whose page_id leaves 7 by 101 end in another character there; those that leave 3 by 211 are gone. The replica keeps
    the offsets of its index.
    """
    damaged = F.concat(F.expr("left(html, length(html) - 1)"), F.lit("~"))
    body = F.when(F.expr("page_id % 101 = 7"), damaged).otherwise(F.col("html"))
    index = stage(warc.archive_index(tables(spark, sf_dir, "pages"), body).withColumn("file", F.lit("archive")), "archive")
    left = index.select("file", "offset", "length", "leaf")
    right = index.where("NOT (record_id % 211 <=> 3)").select("file", "offset", "length", F.col("replica_leaf").alias("leaf"))
    return warc.audit(left, right)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th vector against all others; where vec_id is divisible by 7 the label moves on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(tables(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.repeated_runs(tables(spark, sf_dir, "documents"), runs.planted, full=False)
    return found.drop("n_words", "collapsed", "runs")


def op13_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = records.write_records(tables(spark, sf_dir, "documents"), records.word_vocabulary(), END_ID)
    return records.record_report(index)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_sharding,
        op2_bpe,
        op3_secrets,
        op4_url_filter,
        op5_toxicity,
        op6_decontaminate,
        op7_quality,
        op8_near_duplicates,
        op9_token_counts,
        op10_warc,
        op11_hard_negatives,
        op12_runs,
        op13_records,
    )
}

__all__ = ["ORACLES", "QUERIES", "vocabulary"]
