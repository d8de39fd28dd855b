"""Contiguous shards of near equal bytes, from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipledger.llm.support import stage, text_or_empty


def global_offsets(rows: DataFrame, order: list[str], size: str) -> tuple[DataFrame, DataFrame]:
    """Every row's place in one global order, without sorting in one task.

    Rows are dealt by range and staged, each range's bytes and rows are summed, and the sums of the
    ranges before are added to running sums inside a range. Returns the rows with ``_range``,
    ``_offset`` (bytes before the row) and ``_index`` (rows before it), and one row per range with its
    first offset and index. Equal sort keys may be split between ranges, so a hot key is no hot task.
    """
    ranged = stage(
        rows.repartitionByRange(*[F.col(name) for name in order]).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        # One row per range: as many as Spark has partitions, however large the table is.
        ranged.groupBy("_range")
        .agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
        .select(
            "_range",
            "_bytes",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_first_offset"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first_index"),
        )
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ranged.withColumn("_offset", F.coalesce(F.sum(size).over(earlier), F.lit(0)))
        .withColumn("_index", F.row_number().over(inside).cast("long") - 1)
        .join(F.broadcast(starts.drop("_bytes")), "_range")
        .withColumn("_offset", F.col("_offset") + F.col("_first_offset"))
        .withColumn("_index", F.col("_index") + F.col("_first_index"))
        .drop("_first_offset", "_first_index")
    )
    return placed, starts


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Deal documents into ``shards`` contiguous runs of near equal bytes.

    The order is (first 64 bits of the text's MD5, doc_id), so equal texts lie side by side. A row's shard follows from the
    bytes before it: ``offset * shards // total``. A run of equal texts moves as a whole by its first
    offset, as long as it is no larger than the largest document; larger runs are cut like
    anything else. So every shard differs from total / shards by the largest document at most, on
    either end, and all but the largest groups of copies stay together.

    Returns doc_id, size (UTF-8 bytes plus 1; null counts as empty), text_crc32, law ``bytes``, shard,
    slot (gapless from 0 within a shard, in that order) and grown_shard (null). Null doc_ids come first within
    equal texts; repeated rows each get a slot of their own; no rows give no rows. Other columns are ignored.
    """
    text = text_or_empty()
    keys = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.substring(F.md5(text.cast("binary")), 1, 16).alias("_text"),
    )
    placed, _ = global_offsets(keys, ["_text", "doc_id", "text_crc32", "size"], "size")

    # Runs of equal texts: inside a range by a window, across ranges from each range's edges.
    run = Window.partitionBy("_range", "_text")
    placed = placed.withColumn("_run_start", F.min("_offset").over(run)).withColumn(
        "_run_bytes", F.sum("size").over(run)
    )
    edges = (
        placed.groupBy("_range")
        .agg(
            F.min_by(F.struct("_text", "_run_start", "_run_bytes"), "_index").alias("first"),
            F.max_by(F.struct("_text", "_run_start", "_run_bytes"), "_index").alias("last"),
        )
        .select(F.explode(F.array_distinct(F.array("first", "last"))).alias("edge"))
        .groupBy("edge._text")
        .agg(F.min("edge._run_start").alias("_whole_start"), F.sum("edge._run_bytes").alias("_whole_bytes"))
    )
    totals = placed.agg(F.sum("size").alias("_total"), F.max("size").alias("_largest"))
    sharded = (
        placed.join(F.broadcast(edges), "_text", "left")  # two rows per range at most
        .join(F.broadcast(totals))
        .withColumn("_run_start", F.coalesce("_whole_start", "_run_start"))
        .withColumn("_run_bytes", F.coalesce("_whole_bytes", "_run_bytes"))
        .withColumn(
            "_from",
            F.when(F.col("_run_bytes") <= F.col("_largest"), F.col("_run_start")).otherwise(F.col("_offset")),
        )
        .withColumn("shard", _cut("_from", shards))
    )
    firsts = sharded.groupBy("shard").agg(F.min("_index").alias("_first"))  # a row per shard
    return sharded.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_index") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _cut(offset: str, shards: int) -> Column:
    # In decimals: bytes times shards may pass 64 bits.
    return F.floor(F.col(offset).cast("decimal(30,0)") * shards / F.col("_total")).cast("int")
