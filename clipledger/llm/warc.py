"""WARC records, and a Merkle audit that finds where two replicas of an archive differ.

A record's leaf is the SHA-256 of its bytes. Records are grouped by ranges of their offsets; a range's hash is that of
its children in order, with their offsets; ranges of ranges follow up to one root. Equal roots
mean equal replicas; else only ranges whose hashes differ are opened.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.llm.sharding import global_offsets
from clipledger.llm.support import stage

#: Bytes of the lowest ranges, and ranges to the next higher one.
RANGE_BYTES = 1 << 16
FANOUT = 16
#: How a gzip member begins, and bytes of one that are unpacked at a time.
GZIP = b"\x1f\x8b\x08"
PART_BYTES = 1 << 16


def record_bytes(uri: Column, record_id: Column, body: Column) -> Column:
    """A WARC/1.1 resource record; nulls count as empty."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(uri, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    ).cast("binary")


def archive_index(pages: DataFrame, replica: Column | None = None) -> DataFrame:
    """record_id, offset, length and leaf of every page as a record of one archive, in order of page_id.

    With ``replica``, the html that a replica has of a page, also replica_leaf: that of the replica's record.
    """
    html = {"leaf": F.col("html")} | ({} if replica is None else {"replica_leaf": replica})
    records = pages.select(
        F.col("page_id").alias("record_id"),
        *(record_bytes(F.col("url"), F.col("page_id"), body).alias(name) for name, body in html.items()),
    ).select(
        "record_id",
        F.octet_length("leaf").cast("long").alias("length"),
        *(F.sha2(name, 256).alias(name) for name in html),
    )
    placed, _ = global_offsets(records, ["record_id", *html], "length")
    return placed.select("record_id", F.col("_offset").alias("offset"), "length", *html)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, length and leaf of every record in WARC files, plain or with a gzip member per record.

    Offsets and lengths are those in the file as stored, leaves of the record's bytes after decompression. A
    file is read by one task. Bytes that are no record, or a broken one, are a row up to where the next record begins.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                yield pd.DataFrame(
                    [(name, *entry) for entry in record_spans(bytes(content))], columns=["file", "offset", "length", "leaf"]
                )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "file string, offset long, length long, leaf string")


def record_spans(content: bytes) -> list[tuple[int, int, str]]:
    """(offset, length, leaf) of every record or member; a broken one reaches to where the next begins."""
    out, at = [], 0
    while at < len(content):
        found = _record(content, at) or _member(content, at)
        if found is None:
            end = _next_start(content, at + 1)
            found = end, hashlib.sha256(content[at:end]).hexdigest()
        out.append((at, found[0] - at, found[1]))
        at = found[0]
    return out


def _record(content: bytes, at: int) -> tuple[int, str] | None:
    """End and leaf of the record that begins here; None if there is none, or if its length can't be right."""
    head = content.find(b"\r\n\r\n", at)
    if not content.startswith(b"WARC/", at) or head < 0:
        return None
    for line in content[at:head].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            end = head + 4 + int(value) + 4
            # Either the record is closed or the next one follows: one of both may be damaged.
            if end <= len(content) and (content.endswith(b"\r\n\r\n", at, end) or content.startswith(b"WARC/", end)):
                return end, hashlib.sha256(content[at:end]).hexdigest()
            return None
    return None


def _member(content: bytes, at: int) -> tuple[int, str] | None:
    """End of the gzip member that begins here, and the leaf of what it holds; None if it is broken."""
    if not content.startswith(GZIP, at):
        return None
    machine, leaf = zlib.decompressobj(31), hashlib.sha256()
    try:
        while not machine.eof:
            if at >= len(content):
                return None
            part = content[at : at + PART_BYTES]
            leaf.update(machine.decompress(part))
            at += len(part)
    except zlib.error:
        return None
    return at - len(machine.unused_data), leaf.hexdigest()


def _next_start(content: bytes, at: int) -> int:
    """Where the next record begins, plain or as a gzip member; the end if there is none."""
    plain = content.find(b"\r\n\r\nWARC/", at)
    plain = len(content) if plain < 0 else plain + 4
    at = content.find(GZIP, at, plain)
    while at >= 0:
        try:
            # The magic bytes may turn up within packed data.
            if zlib.decompressobj(31).decompress(content[at : at + PART_BYTES], 5) == b"WARC/":
                return at
        except zlib.error:
            pass
        at = content.find(GZIP, at + 1, plain)
    return plain


def write_member(record: bytes) -> bytes:
    """A record as a gzip member, without a time stamp."""
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", mtime=0) as member:
        member.write(record)
    return out.getvalue()


def ranges(index: DataFrame) -> DataFrame:
    """The lowest ranges: file, at, first, end, hash. A range has the records that begin in it."""
    return (
        index.withColumn("at", F.floor(F.col("offset") / RANGE_BYTES))
        .groupBy("file", "at")
        # Records that begin in 64 KB: a few hundred at most.
        .agg(
            F.min("offset").alias("first"),
            F.max(F.col("offset") + F.col("length")).alias("end"),
            F.sort_array(F.collect_list(F.struct("offset", "length", "leaf"))).alias("children"),
        )
        .select("file", "at", "first", "end", _hash("children"))
    )


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: of ``FANOUT`` neighbouring ranges each."""
    return (
        nodes.groupBy("file", F.floor(F.col("at") / FANOUT).alias("above"))
        .agg(
            F.min("first").alias("first"),
            F.max("end").alias("end"),
            F.sort_array(F.collect_list(F.struct("first", "end", "hash"))).alias("children"),
        )
        .select("file", F.col("above").alias("at"), "first", "end", _hash("children"))
    )


def _hash(children: str) -> Column:
    lines = F.transform(F.col(children), lambda child: F.to_json(child))
    return F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("hash")


def tree(index: DataFrame, levels: int) -> list[DataFrame]:
    """Levels of the tree from the lowest ranges to the roots, the lowest one stored."""
    out = [stage(ranges(index), "ranges")]
    for _ in range(levels - 1):
        out.append(stage(parents(out[-1]), "level"))
    return out


def _levels(*indexes: DataFrame) -> int:
    """Levels until every file has one root."""
    top = max((frame.agg(F.max("offset").alias("o")).first()["o"] or 0) for frame in indexes) // RANGE_BYTES
    levels = 1
    while top > 0:
        top //= FANOUT
        levels += 1
    return levels


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records in which two replicas differ: file, offset, status, and length and leaf on either side.

    Indexes have file (may be null, as one file), offset, length and leaf. Status: ``corrupt`` (both have a record there, with other bytes or
    of another length), ``missing`` (only the left one), ``extra`` (only the right one). Two records at one offset are compared in order of
    length and leaf. Equal or two empty replicas give no rows.
    """
    left, right = (
        stage(frame.select(F.coalesce("file", F.lit("")).alias("file"), "offset", "length", "leaf"), "index")
        for frame in (left, right)
    )
    levels = _levels(left, right)
    trees = [tree(frame, levels) for frame in (left, right)]
    open_ = None
    for a, b in zip(reversed(trees[0]), reversed(trees[1])):
        if open_ is not None:
            a, b = (
                side.withColumn("above", F.floor(F.col("at") / FANOUT))
                .join(open_, ["file", "above"], "left_semi")
                .drop("above")
                for side in (a, b)
            )
        differ = (
            a.select("file", "at", F.col("hash").alias("left"))
            .join(b.select("file", "at", F.col("hash").alias("right")), ["file", "at"], "full")
            .where(~F.col("left").eqNullSafe(F.col("right")))
        )
        open_ = stage(differ.select("file", F.col("at").alias("above")), "open")
    sides = []
    for frame, name in ((left, "left"), (right, "right")):
        inside = frame.withColumn("above", F.floor(F.col("offset") / RANGE_BYTES)).join(open_, ["file", "above"], "left_semi")
        listed = inside.groupBy("file", "offset").agg(F.sort_array(F.collect_list(F.struct("length", "leaf"))).alias("records"))
        sides.append(listed.select("file", "offset", F.posexplode("records").alias("nth", name)))
    both = sides[0].join(sides[1], ["file", "offset", "nth"], "full").where(~F.col("left").eqNullSafe(F.col("right")))
    status = F.when(F.col("right").isNull(), "missing").when(F.col("left").isNull(), "extra").otherwise("corrupt")
    return both.select(
        "file",
        "offset",
        status.alias("status"),
        F.col("left.length").alias("left_length"),
        F.col("right.length").alias("right_length"),
        F.col("left.leaf").alias("left_leaf"),
        F.col("right.leaf").alias("right_leaf"),
    )
