"""Token counts of a corpus for every context limit, from an exact histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipledger.llm.support import encoding, text_or_empty

QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def token_length(path: str, pattern: str, column: str | Column = "text") -> Column:
    """How many tokens a text has under a rank file; null counts as empty."""

    @F.pandas_udf("int")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(path, pattern).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(text)) for text in texts], dtype="int32")

    return lengths(text_or_empty(column))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Documents per encoded length: n_tokens, documents. Combines before the shuffle, so no length is hot."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("documents"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """What every context limit that occurs as a length keeps and cuts.

    Per limit (= n_tokens): documents and tokens of exactly that length; longer_documents and longer_tokens, the
    suffix sums; kept_tokens, if each document were cut at the limit; lost_tokens; cut_documents;
    and rank_from, rank_to: the ranks, from 1, of its documents in order of length, from
    which any quantile is the row whose ranks hold it. Between two lengths, totals are linear in the limit. The
    histogram has a row per distinct length, so one task orders it however many documents there are.
    """
    after = Window.orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        histogram.withColumn("tokens", F.col("n_tokens") * F.col("documents"))
        .withColumn("longer_documents", F.coalesce(F.sum("documents").over(after), F.lit(0)))
        .withColumn("longer_tokens", F.coalesce(F.sum("tokens").over(after), F.lit(0)))
    )
    whole = Window.partitionBy()
    total, count = F.sum("tokens").over(whole), F.sum("documents").over(whole)
    lost = F.col("longer_tokens") - F.col("longer_documents") * F.col("n_tokens")
    return sums.select(
        F.col("n_tokens").cast("long").alias("n_tokens"),
        "documents",
        "tokens",
        "longer_documents",
        "longer_tokens",
        (total - lost).alias("kept_tokens"),
        lost.alias("lost_tokens"),
        F.col("longer_documents").alias("cut_documents"),
        (count - F.col("longer_documents") - F.col("documents") + 1).alias("rank_from"),
        (count - F.col("longer_documents")).alias("rank_to"),
    )


def quantiles(limits: DataFrame, fractions: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Exact quantiles of length: fraction, n_tokens; the smallest length that covers the fraction of documents."""
    wanted = limits.sparkSession.createDataFrame([(float(q),) for q in fractions], "fraction double")
    rank = F.greatest(F.lit(1), F.ceil(F.col("fraction") * F.col("_count")))
    counted = limits.withColumn("_count", F.max("rank_to").over(Window.partitionBy()))
    # A handful of fractions against one row per length.
    return (
        counted.join(F.broadcast(wanted), (rank >= F.col("rank_from")) & (rank <= F.col("rank_to")))
        .select("fraction", "n_tokens")
    )


def kept_at(limits: DataFrame, limit: int) -> DataFrame:
    """Documents, all tokens, and the tokens kept if documents are cut at any ``limit``: one row, from the histogram alone."""
    length = F.least(F.col("n_tokens"), F.lit(limit))
    return limits.agg(
        F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.col("documents") * length), F.lit(0)).alias("kept_tokens"),
    )


def token_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``limit_table`` of all documents. Null and empty texts have length 0; repeated rows count each; no rows, no rows."""
    lengths = docs.select(token_length(path, pattern).alias("n_tokens"))
    return limit_table(length_histogram(lengths))
