"""Identifiers to handles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_handles(identifiers: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds ``handle`` and ``resolved`` to a column ``identifier``.

    An identifier matches a registry row by client name or by handle, the first row in file
    order counts, and rows without a handle never match. The either-or condition is turned into
    one row per alias so that the join is an equality.
    """
    aliases = (
        registry.where(F.col("handle") != "")
        .select(
            F.explode(F.array("client", "handle")).alias("identifier"), "handle", "row_ord"
        )
        .where(F.col("identifier").isNotNull())
        .groupBy("identifier")
        .agg(F.min_by("handle", "row_ord").alias("handle"))
    )
    return identifiers.join(aliases, "identifier", "left").withColumn(
        "resolved", F.col("handle").isNotNull()
    )


def require_resolved(resolved: DataFrame) -> DataFrame:
    """The same rows; evaluating an unresolved one fails the job."""
    missing = F.concat(F.lit("not in the registry: "), F.col("identifier"))
    return resolved.withColumn(
        "handle", F.coalesce(F.col("handle"), F.raise_error(missing).cast("string"))
    )
