"""Which Parquet files under a path hold a table's columns in the same physical types."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.sources import files

UNREAD = "?"


def _opened(path: str):
    """File system and name of a path as Spark lists it, which is not escaped."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def _kinds(columns: list[str]):
    """The types of the columns in each file, from its footer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet

        for batch in batches:
            kinds = []
            for path in batch.column("path").to_pylist():
                try:
                    system, name = _opened(path)
                    with system.open_input_file(name) as file:
                        found = parquet.read_schema(file)
                except (OSError, pa.ArrowException):
                    kinds.append(UNREAD)  # a store that only Spark reaches, or a broken file
                    continue
                kinds.append(
                    "; ".join(f"{name} {found.field(name).type}" for name in columns if name in found.names)
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(kinds, pa.string())], names=["path", "kind"]
            )

    return run


def file_kinds(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """path and kind of every non-empty Parquet file under a path or glob; footers are read by tasks."""
    # Only names and lengths are asked for, so the files' content is not read here.
    found = spark.read.format("binaryFile").load(path).where("length > 0").select("path")
    return found.mapInArrow(_kinds(columns), "path string, kind string")


def by_kind(spark: SparkSession, path: str, columns: list[str]) -> list[tuple[str, list[str]]]:
    """Files by kind, as (root of their partition folders, paths): what one scan can read.

    A single group, or none, where all files are alike. Where pyarrow cannot open a file no groups
    are made, and Spark reads the path by itself.
    """
    kinds = file_kinds(spark, path, columns)
    groups = kinds.groupBy("kind").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("kind").collect()
    if len(groups) < 2 or any(row.kind == UNREAD for row in groups):
        return []
    out = []
    roots = files.matches(spark, path)
    for row in groups:
        for root in roots:
            inside = [one for one in row.paths if one == root or one.startswith(f"{root}/")]
            if inside:
                # A root that is itself a file has no partition folders.
                out.append((root if inside != [root] else root.rsplit("/", 1)[0], inside))
    return out
