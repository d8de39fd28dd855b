"""Session settings the jobs rely on, and where they may write intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings; all can be changed on a running session.
RUNTIME_CONF = {
    # Repeated keys in one JSON object: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Tables written by other tools may hold nanosecond times; contract scans convert them.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Staged pages and state repeat keys and requests; this takes about half the disk of the default.
    "spark.sql.parquet.compression.codec": "zstd",
    # Splits the hot request / video / parent partitions of the joins below.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits a hot client when tables are written (REBALANCE hint).
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Jobs store their steps: once a step is stored, what was shuffled for it goes, and doesn't wait for the driver's garbage collection.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Shuffles begin with many small partitions, whatever the session's number, and small neighbours are read together up to this size:
    # rows become several times larger as text or VARIANT, so larger parts would spill, and a handful of them leaves cores idle at the end.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Pages are far more groups than an aggregate of objects keeps in memory; it would sort twice after all.
    "spark.sql.execution.useObjectHashAggregateExec": "false",
    # Stored items are read whole or field by field of the VARIANT: taking them apart into columns and putting them together again is lost work.
    "spark.sql.variant.inferShreddingSchema": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to a session; returns it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str | None:
    """The folder all executors share, as the cluster names it."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    return value or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def scratch_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder for intermediate tables, under the shared folder of the session.

    Only a local-mode session without a shared folder falls back to a local temporary one.
    """
    base = shared_dir(spark)
    if base:
        return f"{base.rstrip('/')}/clipledger/{name}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="run-", dir="/tmp") + f"/{name}"
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
