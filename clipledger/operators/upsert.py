"""Newest-wins merge, and the order of arrival that settles its ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Where a row stood when it was read: file, block, row within the block.
ARRIVAL = "_arrival"


def with_arrival(scanned: DataFrame) -> DataFrame:
    """Adds ``ARRIVAL`` to rows just read from files: they arrive by file name, then by their place in the file.

    The order is data from here on, so it survives any exchange of rows; and it doesn't depend on how the scan is split, as blocks
    of a file are ordered by their start.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return scanned.select("*", place.alias(ARRIVAL))


# A column of SHA-256 hashes as text, which no shuffle compresses.
HASH, _HASH_BYTES = "author_hash", "_author_hash_bytes"


def hashes_as_bytes(df: DataFrame) -> DataFrame:
    """Hashes in half their length; whatever else the column holds stays text."""
    if dict(df.dtypes).get(HASH) != "string":
        return df
    text = F.col(HASH)
    packed = F.when((F.length(text) == 64) & text.rlike("^[0-9a-f]{64}$"), F.unhex(text))
    return df.withColumn(_HASH_BYTES, packed).withColumn(HASH, F.when(F.col(_HASH_BYTES).isNull(), text))


def hashes_as_text(df: DataFrame) -> DataFrame:
    if _HASH_BYTES not in df.columns:
        return df
    return df.withColumn(HASH, F.coalesce(HASH, F.lower(F.hex(_HASH_BYTES)))).drop(_HASH_BYTES)


def upsert_latest(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: str,
    *,
    scope: Sequence[str] = ("client",),
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per key within ``scope``: the latest ``collected_at`` of both inputs.

    A null ``collected_at`` counts as latest. On equal times an incoming row beats an existing
    one, and among incoming rows the one latest by the ``order`` columns wins. Rows with a null
    key form one group. Without a ``collected_at`` column only the order decides. Where no ``order``
    is given, incoming rows that carry ``ARRIVAL`` (see ``with_arrival``) are ordered by it; it is dropped.

    The row limit of the window runs before the shuffle too, so however many copies one key
    has, each task sends on at most one. Hashes of authors are shuffled in half their length.
    """
    columns = incoming.columns
    if not order and ARRIVAL in columns:
        order = (ARRIVAL,)
    parts = incoming.withColumn("_incoming", F.lit(1))
    if existing is not None:
        parts = existing.withColumn("_incoming", F.lit(0)).unionByName(
            parts, allowMissingColumns=True
        )
    if HASH not in (key, *scope, *order):
        parts = hashes_as_bytes(parts)
    recency = [F.desc_nulls_first("collected_at")] if "collected_at" in columns else []
    # The key leads: it tells more rows apart than the scope, and sorting compares it first.
    latest = Window.partitionBy(key, *scope).orderBy(
        *recency, F.desc("_incoming"), *[F.desc(name) for name in order]
    )
    newest = parts.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1)
    return hashes_as_text(newest.drop("_rank", "_incoming", ARRIVAL))
