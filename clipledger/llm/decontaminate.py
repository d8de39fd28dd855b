"""Benchmark passages in documents, by winnowed fingerprints.

Of every ``WINDOW`` consecutive hashes of ``GRAM`` words the least is kept as a fingerprint. Texts that share
``GRAM + WINDOW - 1`` words in a row share a fingerprint there, in the same place; a joined pair is
extended word by word to both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.support import Words, gram_hashes, mixed, pieces, stage, text_key, utf8_texts

#: Words of a fingerprint, and fingerprints of which the least is kept: spans of 5 + 6 - 1 = 10 words are found.
GRAM, WINDOW = 5, 6
SPAN = GRAM + WINDOW - 1
#: Words to either side that a pair may have to be extended by.
REACH = WINDOW - 1
#: Bits of the filter that holds the benchmark's fingerprints: of this size for any benchmark.
FILTER_BITS = 24

# ASCII letters and digits are word characters, as is all beyond ASCII.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_MARKS = "size int, fingerprint long, at long, before int, context string"


def _marks(hashes: np.ndarray, first: np.ndarray, sizes: list[int], known):
    """Fingerprints of all texts of a batch, laid end to end.

    ``first`` is where the text of a word begins. Yields (size, word index, hash) arrays: winnowed GRAM-grams,
    and all grams of the short ``sizes``. ``known`` says which hashes may matter.
    """
    grams = gram_hashes(hashes, GRAM)
    windows = len(grams) - WINDOW + 1
    if windows > 0:
        whole = first[:windows] == first[SPAN - 1 :]
        view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
        # The rightmost least one of a window; chunks bound the memory.
        chosen = np.zeros(len(grams), dtype=bool)
        for start in range(0, windows, 1 << 18):
            part = np.flatnonzero(whole[start : start + (1 << 18)]) + start
            chosen[part + WINDOW - 1 - np.argmin(view[part, ::-1], axis=1)] = True
        at = np.flatnonzero(chosen)
        at = at[known(grams[at])]
        yield GRAM, at, grams[at]
    for size in sizes:
        short = _short_hashes(hashes, size)
        if len(short):
            at = np.flatnonzero(known(short) & (first[: len(short)] == first[size - 1 :]))
            yield -size, at, short[at]


def _short_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    return mixed(gram_hashes(hashes, size) + np.uint64(size))


def _fingerprints(sizes: list[int], known, item: bool):
    """Arrow batches of (keys..., text) to keys, n_words and a list of marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                yield one(part)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(utf8_texts(batch.column("text")), _WORD_BYTES)
        begins, ends, hashes = words.since, words.to, words.hashes
        counts = ends - begins
        first, last = np.repeat(begins, counts), np.repeat(ends, counts)
        rows = []
        if item:
            # An item of fewer words than a span is one window of its own size.
            lengths = set(counts[(counts > 0) & (counts < SPAN)].tolist())
        else:
            lengths = sizes
        for size, at, values in _marks(hashes, first, sorted(lengths), known):
            for p, value in zip(at.tolist(), values.tolist()):
                if size > 0:
                    lo, hi = max(int(first[p]), p - REACH), min(int(last[p]), p + GRAM + REACH)
                elif item and last[p] - first[p] != -size:
                    continue
                else:
                    lo, hi = p, p - size
                rows.append(
                    (int(first[p]), size, value - (1 << 63), p - int(first[p]), p - lo, words.text(lo, hi))
                )
        rows.sort(key=lambda row: row[0])
        starts = np.array([row[0] for row in rows], dtype=np.int64)
        # A text without words has no mark and shares its begin with the next one.
        bounds = np.concatenate([np.searchsorted(starts, begins), [len(rows)]])
        bounds = np.minimum.accumulate(bounds[::-1])[::-1]
        columns = list(zip(*rows)) if rows else [()] * 6
        marks = pa.StructArray.from_arrays(
            [
                pa.array(columns[1], type=pa.int32()),
                pa.array(columns[2], type=pa.int64()),
                pa.array(columns[3], type=pa.int64()),
                pa.array(columns[4], type=pa.int32()),
                pa.array(columns[5], type=pa.string()),
            ],
            names=["size", "fingerprint", "at", "before", "context"],
        )
        listed = pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), marks)
        kept = [name for name in batch.schema.names if name != "text"]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in kept), pa.array(counts), listed], names=[*kept, "n_words", "marks"]
        )

    return run


def _spans(pairs: DataFrame) -> DataFrame:
    """Extends joined marks; adds ``start`` and ``length`` of the shared run of words, null where it is too short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(name).to_pylist() for name in ("size", "at", "before", "context", "i_before", "i_context")]
            for size, at, before, context, i_before, i_context in zip(*columns):
                a, b = context.split(" "), i_context.split(" ")
                left = 0
                while left < min(before, i_before) and a[before - left - 1] == b[i_before - left - 1]:
                    left += 1
                right = 0
                while before + right < len(a) and i_before + right < len(b) and a[before + right] == b[i_before + right]:
                    right += 1
                long_enough = right >= -size if size < 0 else right >= GRAM and left + right >= SPAN
                out.append((at - left, left + right) if long_enough else (None, None))
            start, length = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in ("doc_id", "key", "item_id")]
                + [pa.array(start, type=pa.int64()), pa.array(length, type=pa.int64())],
                names=["doc_id", "key", "item_id", "start", "length"],
            )

    schema = "doc_id long, key struct<a:long,b:long>, item_id long, start long, length long"
    columns = ["doc_id", "key", "item_id", "size", "at", "before", "context", "i_before", "i_context"]
    return pairs.select(*columns).mapInArrow(run, schema).where("start is not null")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, key (of its text), n_words, n_hit, item_ids (sorted as strings).

    Words are runs of ASCII letters (A-Z lower-cased) and digits and of characters beyond ASCII. A window is ten words of an item in a row,
    or a shorter item as a whole. A document's word is hit if it lies in an occurrence of a window. Null and empty texts
    have no words; items without words have no windows; an item without an id hits words but isn't listed; repeated
    rows each give a row, repeated items one. An empty benchmark hits nothing.
    """
    none = lambda hashes: np.ones(len(hashes), dtype=bool)
    items = stage(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .mapInArrow(_fingerprints([], none, True), f"item_id long, n_words long, marks array<struct<{_struct(_MARKS)}>>")
        .select("item_id", F.inline("marks")),
        "items",
    )
    sizes = sorted(-row["size"] for row in items.where("size < 0").select("size").distinct().collect())  # nine at most
    bits = _filter(items)

    def known(hashes: np.ndarray) -> np.ndarray:
        cell = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        return (bits.value[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1

    marked = stage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text").mapInArrow(
            _fingerprints(sizes, known, False),
            f"doc_id long, key struct<a:long,b:long>, n_words long, marks array<struct<{_struct(_MARKS)}>>",
        ),
        "marks",
    )
    pairs = (
        marked.select("doc_id", "key", F.inline("marks"))
        .distinct()  # repeated rows need looking at once
        .join(
            items.select(
                "item_id", "size", "fingerprint", F.col("before").alias("i_before"), F.col("context").alias("i_context")
            ).distinct(),
            ["size", "fingerprint"],
        )
    )
    # As many spans and items as a document has words and the benchmark items.
    hits = (
        _spans(pairs)
        .groupBy(F.coalesce("doc_id", F.lit(0)).alias("h_id"), F.col("doc_id").isNull().alias("h_null"), F.col("key").alias("h_key"))
        .agg(
            F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
        )
        .withColumn(
            "n_hit",
            F.aggregate(
                "spans",
                F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
                lambda seen, span: F.struct(
                    (seen["n"] + F.greatest(F.lit(0), span["end"] - F.greatest(seen["to"], span["start"]))).alias("n"),
                    F.greatest(seen["to"], span["end"]).alias("to"),
                ),
                lambda seen: seen["n"],
            ),
        )
    )
    same = (
        (F.coalesce("doc_id", F.lit(0)) == F.col("h_id"))
        & (F.col("doc_id").isNull() == F.col("h_null"))
        & (F.col("key") == F.col("h_key"))
    )
    return (
        marked.select("doc_id", "key", "n_words")
        .join(hits, same, "left")
        .select(
            "doc_id",
            "key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )


def _struct(ddl: str) -> str:
    return ",".join(part.strip().replace(" ", ":", 1) for part in ddl.split(","))


def _filter(items: DataFrame):
    """A bitmap of the benchmark's fingerprints, 2 MB for any benchmark; a bit too many costs rows, none is missing.

    Each task sets the bits of its items; the maps are combined in groups by part of the map.
    """
    step = 1 << (FILTER_BITS - 3 - 6)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [np.empty(0, np.int64)]
        for batch in batches:
            values = batch.column("fingerprint").to_numpy(zero_copy_only=False)
            hashes = values.astype(np.uint64) + np.uint64(1 << 63)
            cells.append(np.unique((hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)))
        cell = np.unique(np.concatenate(cells))
        yield pa.RecordBatch.from_arrays([pa.array(cell)], names=["cell"])

    def pack(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        cell = table.column("cell").to_numpy() - part * 8 * step
        packed = np.packbits(np.bincount(cell, minlength=8 * step) > 0, bitorder="little")
        return pa.table({"part": [part], "packed": pa.array([packed.tobytes()], type=pa.binary())})

    cells = items.select("fingerprint").mapInArrow(fill, "cell long").distinct()
    parts = (
        cells.select((F.col("cell") / (8 * step)).cast("long").alias("part"), "cell")
        .groupBy("part")
        .applyInArrow(pack, "part long, packed binary")
        .collect()  # 64 parts of 32 KB at most
    )
    bits = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for row in parts:
        bits[row["part"] * step : (row["part"] + 1) * step] = np.frombuffer(bytes(row["packed"]), np.uint8)
    return items.sparkSession.sparkContext.broadcast(bits)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
