"""A training corpus from ``documents``: filter, deduplicate, decontaminate, redact, encode.

Each stage is written as Parquet and read again for the next one. All but the last keep the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.llm import bpe, decontaminate, near_duplicates, secrets, toxicity
from clipledger.llm.queries import vocabulary
from clipledger.llm.support import discard, hidden, recorded, stage, tables, text_key
from clipledger.sources import files

TOXIC_FROM = 0.7


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders that the stage before has left: its result reads them until it is written.
_left: list[str] = []


def tidy(step: Stage) -> Stage:
    """Before a stage begins, removes what the one before has staged: by then its result is written and reread.

    What ``docs`` itself still reads stays. One pipeline runs in a process at a time.
    """

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _left:
            read = {path.rsplit("/", 1)[0] for path in docs.inputFiles()}
            for folder in [one for one in _left if not any(path.endswith(one.rsplit("/", 1)[1]) for path in read)]:
                files.remove(spark, folder)
            _left.clear()
        with recorded() as made:
            result = step(spark, docs, sf_dir)
        _left.extend(made)
        return result

    return run


@tidy
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC_FROM``; the lexicon is learned from the labels of the documents at hand."""
    lexicon = toxicity.learn(docs, tables(spark, sf_dir, "labels"))
    score = hidden("score")
    return docs.withColumn(score, toxicity.toxicity_score(lexicon)).where(F.col(score) < TOXIC_FROM).drop(score)


@tidy
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the 0.8 similarity join: the one with the least doc_id.

    Rows are told apart by numbers that are stored with them: a second scan may be split otherwise, and number them anew.
    """
    row = hidden("row")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    # Stored, so that its size is known: where it is small, documents aren't shuffled to meet it.
    gone = stage(near_duplicates.surplus(numbered, row), "gone")
    return numbered.join(gone, row, "left_anti").drop(row)


@tidy
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    found = decontaminate.contamination(docs, tables(spark, sf_dir, "benchmark")).where("n_hit > 0")
    key = hidden("key")
    gone = stage(found.select(F.col("key").alias(key)).distinct(), "gone")
    return docs.withColumn(key, text_key()).join(gone, key, "left_anti").drop(key)


@tidy
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars follows the text where it changed."""
    spans = hidden("spans")
    marked = docs.withColumn(spans, secrets.secret_spans(*vocabulary()).getField("spans"))
    changed = F.col(spans) != ""
    out = marked.withColumn("text", secrets.redacted("text", F.col(spans)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.drop(spans)


@tidy
def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of every document, and the digests of ids and of the bytes they decode to."""
    path, pattern = vocabulary()
    return bpe.encode_digests(docs, path, pattern, keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("byte_level_bpe", encode_documents),
]

#: Neither learned scores nor byte-pair merges can be stated in SQL; tests hold every stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = tables(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)  # what the stage before has written
        before = docs
    return docs
