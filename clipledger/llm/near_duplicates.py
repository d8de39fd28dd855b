"""Documents whose sets of word shingles are alike, by T-occurrence search over inverted lists.

Two sets of sizes n and m have a Jaccard similarity of 0.8 or more if they share T = ceil(4 (n + m) / 9) shingles. Equal
sets are one class. Every shingle's number of sets is counted first; with shingles in the order of these counts, alike sets
share one of their first n - ceil(0.8 n) + 1 shingles, so sets that begin with shingles of their own take no part any more. What
shares such shingles, directly or through others, is a family. Families are then searched block against block: the lists of a query's
rarer shingles are merged and counted, those that reach T less the number of longest lists are probed in these by
binary search (DivideSkip). Every link is found, within and across blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.components import connected
from clipledger.llm.support import LOWER, PIECE_BYTES, Words, discard, give_back, gram_hashes, mixed, pieces, stage, utf8_texts

SHINGLE = 5
#: Bits of a shingle's hash by which it is counted; a collision only moves a shingle in the order.
COUNT_BITS = 42
#: Shingles that one task counts, about.
COUNTED_TOGETHER = 2_000_000
#: Counts up to this one are told apart; above it, eight to every doubling.
EXACT_COUNT = 128
#: Shingles of a block. A family has up to ``FINE_BLOCKS`` small blocks, so that it is spread; more only beyond large ones.
BLOCK_SHINGLES, FINE_SHINGLES, FINE_BLOCKS = 800_000, 50_000, 16
#: DivideSkip's weight of probing against merging.
PROBE_COST = 0.0085


def least_overlap(n: int, m: int) -> int:
    """Shingles that sets of sizes n and m share if 100 * intersection >= 80 * union."""
    return -(-4 * (n + m) // 9)


class Sets:
    """The shingle sets of several texts: sorted 64-bit hashes end to end, their sizes, and 128 bits that stand for each.

    Shingles are of five words; a text of fewer is one shingle. A text without words has an empty set.
    """

    def __init__(self, texts: list[bytes | None]):
        words = Words(texts, LOWER)
        grams = gram_hashes(words.hashes, SHINGLE)
        sets = []
        for since, to in zip(words.since.tolist(), words.to.tolist()):
            if to - since >= SHINGLE:
                one = np.sort(grams[since : to - SHINGLE + 1])
                new = np.empty(len(one), bool)
                new[0] = True
                np.not_equal(one[1:], one[:-1], out=new[1:])
                sets.append(one[new])
            elif to > since:
                size = to - since
                sets.append(mixed(gram_hashes(words.hashes[since:to], size) + np.uint64(size)))
            else:
                sets.append(np.empty(0, np.uint64))
        self.sizes = np.array([len(one) for one in sets], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        self.flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        other = mixed(self.flat ^ np.uint64(0xD1B54A32D192ED03)) * np.uint64(0x2545F4914F6CDD1D)
        self.a, self.b = (self._sums(values).view(np.int64) for values in (mixed(self.flat), other))

    def _sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[self.ends] - total[self.ends - self.sizes]

    def of(self, at: int) -> np.ndarray:
        return self.flat[self.ends[at] - self.sizes[at] : self.ends[at]]


class Seen:
    """Sets met before in this task; forgets all once it holds ``limit``, as a set met twice does no harm."""

    def __init__(self, limit: int = 500_000):
        self.keys, self.limit = set(), limit

    def new(self, sets: Sets) -> list[int]:
        out = []
        for at, (n, a, b) in enumerate(zip(sets.sizes.tolist(), sets.a.tolist(), sets.b.tolist())):
            if n and (a, b) not in self.keys:
                if len(self.keys) >= self.limit:
                    self.keys.clear()
                self.keys.add((a, b))
                out.append(at)
        return out


# -- texts, in pieces -----------------------------------------------------------------------------------
def _packed(texts: list[bytes]) -> bytes:
    sizes = np.array([len(texts), *map(len, texts)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(texts))


def _unpacked(blob: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    count = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = np.frombuffer(data, "<i8", count, 8)
    ends = 8 * (count + 1) + np.cumsum(sizes)
    return [data[end - size : end] for end, size in zip(ends.tolist(), sizes.tolist())]


def _signatures(carry: list[str]):
    """Rows of documents, and rows of pieces: the texts of sets that the task met for the first time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, number = Seen(), TaskContext.get().partitionId() << 32
        names = ["doc_id", *carry, "n", "a", "b", "piece", "blob"]
        for batch in batches:
            kinds = [batch.column(name).type for name in ["doc_id", *carry]]
            for part in pieces(batch):
                texts = utf8_texts(part.column("text"))
                sets = Sets(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(name) for name in ["doc_id", *carry]),
                        *(pa.array(values) for values in (sets.sizes, sets.a, sets.b)),
                        pa.nulls(part.num_rows, pa.int64()),
                        pa.nulls(part.num_rows, pa.binary()),
                    ],
                    names=names,
                )
                new = [texts[at] or b"" for at in seen.new(sets)]
                if new:
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.nulls(1, kind) for kind in kinds),
                            *[pa.nulls(1, pa.int64())] * 3,
                            pa.array([number], pa.int64()),
                            pa.array([_packed(new)], pa.binary()),
                        ],
                        names=names,
                    )
                    number += 1
        give_back()

    return run


# -- how many sets hold a shingle -------------------------------------------------------------------------
def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _borders(cells: np.ndarray, ranges: int) -> np.ndarray:
    """Where sorted cells pass from one range to the next."""
    cuts = [(k << COUNT_BITS) // ranges for k in range(1, ranges)]
    return np.concatenate([[0], np.searchsorted(cells, np.array(cuts, np.int64)), [len(cells)]])


def _chunks(ranges: int):
    """The cells of each piece's shingles, sorted, as differences, by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece, blob in zip(batch.column("piece").to_pylist(), batch.column("blob").to_pylist()):
                cells = np.sort(_cells(Sets(_unpacked(blob)).flat))
                borders = _borders(cells, ranges)
                rows = []
                for k, (a, b) in enumerate(zip(borders.tolist(), borders[1:].tolist())):
                    if b > a:
                        steps = np.diff(cells[a:b], prepend=0).astype("<u8")
                        planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)  # equal bytes side by side
                        rows.append((k, packer.compress(planes.tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _ in rows], pa.int32()),
                        pa.array([piece] * len(rows), pa.int64()),
                        pa.array([data for _, data in rows], pa.binary()),
                    ],
                    names=["cells", "piece", "steps"],
                )
        give_back()

    return run


def _codes(counts: np.ndarray) -> np.ndarray:
    """A byte for each count; never less for a greater one."""
    large = EXACT_COUNT + 8 * np.log2(np.maximum(counts, 1) / EXACT_COUNT)
    return np.minimum(np.where(counts <= EXACT_COUNT, counts, large), 255).astype(np.uint8)


def _counted(table: pa.Table) -> pa.Table:
    """Codes of the counts of one range's cells, for each piece in the order of its cells."""
    unpacker, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    parts = []
    for data in table.column("steps").to_pylist():
        planes = np.frombuffer(unpacker.decompress(data), np.uint8)
        steps = np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8")[:, 0]
        parts.append(np.cumsum(steps.astype(np.int64)))
    _, which, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    codes = _codes(count)[which]
    ends = np.cumsum([len(part) for part in parts]).tolist()
    packed = [packer.compress(codes[end - len(part) : end].tobytes()) for part, end in zip(parts, ends)]
    del parts, which, count, codes
    give_back()
    return pa.table(
        {"piece": table.column("piece"), "cells": table.column("cells"), "codes": pa.array(packed, pa.binary())}
    )


def size_band(n: int) -> int:
    """Sizes in bands: alike sets, the smaller at least 0.8 of the larger, lie in the same or in neighbouring ones."""
    # The tiny step up keeps rounding from putting exact ratios two bands apart.
    return int(math.log(n) / (math.log(1.25) * (1 + 1e-9)))


def prefix_length(n: int) -> int:
    """So many of its first shingles in any common order: one of them is shared with every set that is alike."""
    return n - -(-4 * n // 5) + 1


_LISTED = "gram long, node long, band int, a long, b long, packed binary"


def _prefixes(piece: pa.Table, counts: pa.Table) -> pa.Table:
    """Of every set the first shingles in the order of counts, those that other sets hold too; and the texts of sets that have any."""
    grams, nodes, bands = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    held = []
    unpacker, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
    for blob in piece.column("blob").to_pylist():  # one
        texts = _unpacked(blob)
        sets = Sets(texts)
        ranged = sorted(zip(counts.column("cells").to_pylist(), counts.column("codes").to_pylist()))
        sorted_codes = np.frombuffer(b"".join(unpacker.decompress(data) for _, data in ranged), np.uint8)
        codes = np.empty(len(sets.flat), np.uint8)
        codes[np.argsort(_cells(sets.flat), kind="stable")] = sorted_codes
        for at in range(len(texts)):
            one, of_one = sets.of(at), codes[sets.ends[at] - sets.sizes[at] : sets.ends[at]]
            # Stable: equal codes stay in order of their hashes.
            first = np.argsort(of_one, kind="stable")[: prefix_length(len(one))]
            first = first[of_one[first] > 1]
            if len(first):
                grams.append(one[first])
                nodes.append(np.full(len(first), sets.a[at]))
                bands.append(np.full(len(first), size_band(len(one)), np.int32))
                held.append((int(sets.a[at]), int(sets.b[at]), packer.compress(texts[at])))
    give_back()
    found, more = np.concatenate(grams).view(np.int64), len(held)
    a, b, packed = zip(*held) if held else ((), (), ())
    none = len(found)
    return pa.table(
        {
            "gram": pa.concat_arrays([pa.array(found), pa.nulls(more, pa.int64())]),
            "node": pa.concat_arrays([pa.array(np.concatenate(nodes)), pa.nulls(more, pa.int64())]),
            "band": pa.concat_arrays([pa.array(np.concatenate(bands)), pa.nulls(more, pa.int32())]),
            "a": pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(a, pa.int64())]),
            "b": pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(b, pa.int64())]),
            "packed": pa.concat_arrays([pa.nulls(none, pa.binary()), pa.array(packed, pa.binary())]),
        }
    )


# -- search -------------------------------------------------------------------------------------------------
def search(sets: list[np.ndarray], sides: list[int] | None = None) -> list[tuple[int, int]]:
    """All pairs of alike sets, as (i, j) by position; given ``sides``, only those of different sides.

    Sets are taken in order of size, each as a query against the smaller ones that may reach 0.8.
    """
    by_size = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in by_size], dtype=np.int64)
    side = np.array([sides[i] for i in by_size], np.int64) if sides is not None else None
    flat = np.concatenate([sets[i] for i in by_size])
    owner = np.repeat(np.arange(len(by_size), dtype=np.int32), sizes)
    _, key = np.unique(flat, return_inverse=True)
    key = key.astype(np.int32)
    # Inverted lists end to end; owners ascend within each.
    postings = owner[np.argsort(key, kind="stable")]
    length = np.bincount(key)
    start = np.cumsum(length) - length
    begin = np.cumsum(sizes) - sizes
    links = []
    for q in range(1, len(by_size)):
        n = int(sizes[q])
        low = int(np.searchsorted(sizes, -(-4 * n // 5)))  # 100 m >= 80 n
        if low >= q:
            continue
        keys = key[begin[q] : begin[q] + n]
        keys = keys[length[keys] > 1]
        least = least_overlap(n, int(sizes[low]))
        if len(keys) < least:
            continue
        order = keys[np.argsort(length[keys], kind="stable")]
        longest = max(int(length[order[-1]]), 2)
        long_lists = min(len(order) - 1, least - 1, int(least / (PROBE_COST * math.log2(longest) + 1)))
        short, probed = order[: len(order) - long_lists], order[len(order) - long_lists :]
        merged = postings[_runs(start[short], length[short])]
        merged = merged[(merged >= low) & (merged < q)]
        if side is not None:
            merged = merged[side[merged] != side[q]]
        candidates, counts = np.unique(merged, return_counts=True)
        enough = counts >= least - long_lists
        probed = np.sort(probed)
        for r, count in zip(candidates[enough].tolist(), counts[enough].tolist()):
            own = key[begin[r] : begin[r] + sizes[r]]  # ascends, as sets are sorted
            at = np.minimum(np.searchsorted(own, probed), len(own) - 1)
            if count + int((own[at] == probed).sum()) >= least_overlap(n, int(sizes[r])):
                links.append((by_size[q], by_size[r]))
    return links


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total, dtype=np.int64)


#: Links (u, v), or what u's links of one task add up to.
_LINKS = "u string, v string, links long"


def _link(every: bool):
    """Searches one cell: a block of a family in itself, or two blocks against each other.

    ``every``: all links as rows. Else as many as connect what is linked, and sums of linked documents.
    """

    def run(table: pa.Table) -> pa.Table:
        names = [f"{a}:{b}" for a, b in zip(table.column("a").to_pylist(), table.column("b").to_pylist())]
        sides, copies = table.column("block").to_pylist(), table.column("copies").to_pylist()
        crossing = len(set(sides)) > 1
        cell = table.column("cell")[0].as_py()
        if len(names) < 2 or (cell["low"] != cell["high"] and not crossing):
            return pa.table({"u": pa.array([], pa.string()), "v": pa.array([], pa.string()), "links": pa.array([], pa.int64())})
        order = sorted(range(len(names)), key=names.__getitem__)
        found = search(_loaded(table.column("packed").to_pylist(), order), [sides[k] for k in order] if crossing else None)
        found = [(order[i], order[j]) for i, j in found]
        sums = np.zeros(len(names), np.int64)
        leader = list(range(len(names)))

        def lead(k: int) -> int:
            while leader[k] != k:
                leader[k] = leader[leader[k]]
                k = leader[k]
            return k

        kept = []
        for i, j in found:
            sums[i] += copies[j]
            sums[j] += copies[i]
            first, second = lead(i), lead(j)
            if every or first != second:
                leader[first] = second
                kept.append((names[i], names[j], None))
        if not every:
            kept += [(names[k], None, int(sums[k])) for k in np.flatnonzero(sums).tolist()]
        columns = list(zip(*kept)) or [()] * 3
        return pa.table({name: pa.array(column, kind) for name, column, kind in zip(("u", "v", "links"), columns, (pa.string(), pa.string(), pa.int64()))})

    return run


def _loaded(packed: list[bytes], order: list[int]) -> list[np.ndarray]:
    """Sets of compressed texts, a piece at a time: hashing needs more room than what is kept."""
    unpacker = zstandard.ZstdDecompressor()
    sizes = [zstandard.frame_content_size(packed[k]) for k in order]
    sets: list[np.ndarray] = []
    while len(sets) < len(order):
        at = end = len(sets)
        size = 0
        while end < len(order) and (end == at or size + sizes[end] <= PIECE_BYTES):
            size += sizes[end]
            end += 1
        made = Sets([unpacker.decompress(packed[k]) for k in order[at:end]])
        sets += [made.of(k).copy() for k in range(end - at)]
    return sets


class Links:
    """Classes of equal sets, the rows that belong to them, and the links between classes, all stored."""

    def __init__(self, docs: DataFrame, carry: tuple[str, ...] = (), block_shingles: int = BLOCK_SHINGLES, every: bool = False):
        carry = list(carry)
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, "text")
        kinds = ", ".join(f"`{name}` {kind}" for name, kind in texts.select("doc_id", *carry).dtypes)
        first = stage(
            texts.mapInArrow(_signatures(carry), f"{kinds}, n long, a long, b long, piece long, blob binary"), "signatures"
        )
        self.rows = stage(first.where("n is not null").drop("piece", "blob"), "rows")
        self.classes = self.rows.where("n > 0").groupBy("a", "b").agg(
            F.min("doc_id").alias("low"), F.max("n").alias("n"), F.count("*").alias("copies")
        )
        met, held = self._lists(first.where("piece is not null").select("piece", "blob"))
        discard(first)
        family = connected(_meetings(met), "families")  # of 64-bit nodes: a collision only joins two families
        discard(met)
        chosen = stage(
            family.join(self.classes, family["node"] == self.classes["a"]).select(
                F.col("label").alias("family"), "a", "b", "n", "copies"
            ),
            "chosen",
        )
        blocks = F.greatest(
            F.least(F.ceil(F.sum("n") / min(block_shingles, FINE_SHINGLES)), F.lit(FINE_BLOCKS)),
            F.ceil(F.sum("n") / block_shingles),
        )
        sized = chosen.join(chosen.groupBy("family").agg(blocks.cast("int").alias("blocks")), "family")
        # One text of each class: tasks that met the same set each hold it.
        members = stage(held.join(sized, ["a", "b"]).dropDuplicates(["a", "b"]), "members")
        discard(held, chosen)
        placed = members.withColumn("block", F.expr("CAST(pmod(xxhash64(a, b), blocks) AS int)"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        cells = placed.withColumn("other", other).withColumn(
            "cell",
            F.struct("family", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")),
        )
        self.links = stage(
            cells.select("cell", "block", "a", "b", "copies", "packed").groupBy("cell").applyInArrow(_link(every), _LINKS), "links"
        )
        discard(members)

    def _lists(self, found: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Postings of shared shingles at the head of sets, and the texts of the sets that have any."""
        total = self.rows.agg(F.sum("n")).first()[0] or 0
        ranges = max(1, -(-total // COUNTED_TOGETHER))
        counted = stage(
            found.mapInArrow(_chunks(ranges), "cells int, piece long, steps binary")
            .groupBy("cells")
            .applyInArrow(_counted, "piece long, cells int, codes binary"),
            "counts",
        )
        listed = stage(found.groupBy("piece").cogroup(counted.groupBy("piece")).applyInArrow(_prefixes, _LISTED), "listed")
        discard(counted)
        postings = listed.where("packed is null").select("gram", "node", "band")
        shared = postings.groupBy("gram").agg(F.min("node").alias("u"), F.max("node").alias("v")).where("u <> v").select("gram")
        met = stage(postings.join(stage(shared, "shared"), "gram", "left_semi").distinct(), "met")
        return met, listed.where("packed is not null").select("a", "b", "packed")

    def labelled(self) -> DataFrame:
        """Every class with its component: a, b, low, copies, node, label."""
        labels = connected(self.links.where("v is not null").select("u", "v"), "linked")
        node = F.concat_ws(":", "a", "b")
        found = self.classes.select("a", "b", "low", "copies", node.alias("node")).join(labels, "node", "left")
        return found.withColumn("label", F.coalesce("label", "node"))


def _meetings(met: DataFrame) -> DataFrame:
    """Within a list only sets of neighbouring size bands meet: each with the least one of its band, and these of
    neighbouring bands with each other."""
    least = met.groupBy("gram", "band").agg(F.min("node").alias("u"))
    above = least.select("gram", (F.col("band") - 1).alias("band"), F.col("u").alias("v"))
    return (
        met.join(least, ["gram", "band"])
        .select("u", F.col("node").alias("v"))
        .unionByName(least.join(above, ["gram", "band"]).select("u", "v"))
        .where("u <> v")
        .distinct()
    )


def link_documents(
    docs: DataFrame, carry: tuple[str, ...] = (), block_shingles: int = BLOCK_SHINGLES, counts: bool = False
) -> DataFrame:
    """doc_id, the ``carry`` columns, n_shingles and component_id of every row; with ``counts`` also n_links.

    component_id is the least doc_id that links lead to, the document's own included; null doc_ids count for
    nothing, and where a component has no doc_id it is null. n_links: the other rows a row is linked with, copies included. Null
    and empty texts, and those of blanks only, have no shingles and are linked with nothing. Equal texts and repeated
    rows are linked. No rows give no rows. Words and shingles are told apart by 64-bit hashes.
    """
    made = Links(docs, carry, block_shingles)
    labelled = stage(made.labelled(), "labelled")
    lowest = labelled.groupBy("label").agg(F.min("low").alias("component_id"))
    of_class = labelled.join(lowest, "label").select("a", "b", "node", "copies", "component_id", F.lit(True).alias("found"))
    columns = []
    if counts:
        sums = made.links.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
        of_class = of_class.join(sums, "node", "left")
        columns = [F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).alias("n_links")]
    return made.rows.join(of_class, ["a", "b"], "left").select(
        "doc_id",
        *carry,
        F.col("n").alias("n_shingles"),
        F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *columns,
    )


def linked_classes(docs: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """The whole join: class of every row (doc_id, class_id; null without shingles), and all links between different
    classes (class_u, class_v), each once. Rows of a class are equal sets, linked without being listed."""
    made = Links(docs, (), block_shingles, every=True)
    name = F.when(F.col("n") > 0, F.concat_ws(":", "a", "b"))
    pairs = made.links.select(F.least("u", "v").alias("class_u"), F.greatest("u", "v").alias("class_v"))
    return made.rows.select("doc_id", name.alias("class_id")), pairs


def surplus(docs: DataFrame, row: str) -> DataFrame:
    """Values of the unique column ``row`` of documents that go, so that one of each component stays: the least doc_id.

    Documents without shingles all stay; among rows with the same least doc_id, and in components without any doc_id, the one with the
    least ``row`` stays.
    """
    made = Links(docs, (row,))
    of_class = stage(made.labelled().select("a", "b", "label"), "labelled")
    linked = stage(made.rows.join(of_class, ["a", "b"]).select("doc_id", row, "label"), "linked")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(row).alias("row"))
    keep = stage(linked.groupBy("label").agg(F.min(place).alias("first")).select(F.col("first.row").alias(row)), "kept")
    return linked.join(keep, row, "left_anti").select(row)
