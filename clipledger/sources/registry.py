"""The client registry: one CSV row per client with its profile links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.functions import scalars as S
from clipledger.sources.contracts import REGISTRY_COLUMNS


#: A line that begins outside quotes and ends inside: whole fields, then a quote that isn't closed.
OPEN_QUOTE = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+$'


def registry_scan(spark: SparkSession, path: str) -> DataFrame:
    """Registry rows with the derived handle and their place in the file.

    Columns are matched by header name, a missing one is null, and a missing file is an error.
    Quoted values may hold line breaks, commas and doubled quotes; a byte-order mark is no part of
    the first name. ``row_ord`` orders by file, then block, then line, so it survives split and parallel reads.

    A break inside quotes cannot be told from a row's end in the middle of a file. So lines are looked at first: if any ends inside
    quotes, each file is read by one task, and breaks inside values read as LF where rows end in CR LF; else files are split.
    """
    broken = spark.read.text(path).where(F.col("value").rlike(OPEN_QUOTE))
    rows = spark.read.csv(path, header=True, escape='"', inferSchema=False, multiLine=not broken.isEmpty())
    columns = [
        (F.col(name) if name in rows.columns else F.lit(None).cast("string")).alias(name)
        for name in REGISTRY_COLUMNS
    ]
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return rows.select(*columns, place.alias("row_ord")).withColumn(
        "handle", S.handle_from_url(F.col("tiktok"))
    )
