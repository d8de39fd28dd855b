"""Byte-level BPE over a corpus: every distinct pre-token is encoded once, and texts are put together from the results.

Documents are cut into blocks. A block keeps its distinct pre-tokens and, for each document, the positions as numbers
into them; the pre-tokens go through one global shuffle in which each distinct one is encoded once, their ids go back to
the blocks, and the ids of a document follow by position. Decoding looks every id up in the table of token bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.support import encoding, give_back, pieces, rank_table, text_or_empty

#: A block ends once it holds so many characters.
BLOCK_CHARS = 8_000_000
#: Ids that are decoded at a time.
DECODE_IDS = 500_000
#: Distinct words of blocks that one encoding task gets, about.
TASK_WORDS = 2_000_000
#: Groups that the words of a block fall into at least; they are merged when there are few words.
SLOTS = 16

# Rows of documents go by their block (from 0 up), rows of words by their slot (-1 and below).
_ROUTED = "route long, block long, doc_ids binary, lengths binary, codes binary, ranks binary, words binary"


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(array.tobytes() for array in arrays)


def _pack_codes(codes: np.ndarray) -> bytes:
    """Frequent words in a byte, the others in three more."""
    rare = codes >= 255
    rest = codes[rare].astype("<u4").view(np.uint8).reshape(-1, 4)
    planes = [np.where(rare, 255, codes).astype(np.uint8).tobytes(), *(rest[:, k].tobytes() for k in range(4))]
    return zstandard.ZstdCompressor(level=1).compress(np.uint64(len(codes)).tobytes() + b"".join(planes))


def _unpack_codes(packed: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(packed)
    count = int(np.frombuffer(data, np.uint64, 1)[0])
    codes = np.frombuffer(data, np.uint8, count, 8).astype(np.uint32)
    rare = codes == 255
    rest = np.frombuffer(data, np.uint8, offset=8 + count).reshape(4, -1)
    codes[rare] = np.ascontiguousarray(rest.T).view("<u4").ravel()
    return codes


def _pack_ragged(items: list[bytes]) -> bytes:
    lengths = np.array([len(item) for item in items], dtype="<u4")
    return zstandard.ZstdCompressor(level=3).compress(
        np.uint64(len(items)).tobytes() + lengths.tobytes() + b"".join(items)
    )


def _unpack_ragged(packed: bytes) -> tuple[np.ndarray, bytes]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    count = int(np.frombuffer(data, np.uint64, 1)[0])
    return np.frombuffer(data, "<u4", count, 8), data[8 + 4 * count :]


def _pack_ascending(values: np.ndarray) -> bytes:
    steps = np.diff(values, prepend=0).astype("<u4")
    planes = steps.view(np.uint8).reshape(-1, 4)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes[:, k].tobytes() for k in range(4)))


def _unpack_ascending(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))


def _slot_of(word: bytes, slots: int) -> int:
    return xxhash.xxh3_64_intdigest(word, seed=1) % slots


def _blocks(pattern: str, block_chars: int, slots: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split = regex.compile(pattern).findall
        made = 0

        def close(keys: list, codes: list, number: dict):
            nonlocal made
            block = (TaskContext.get().partitionId() << 32) + made
            made += 1
            flat = np.concatenate(codes) if codes else np.empty(0, np.uint32)
            order = np.argsort(-np.bincount(flat, minlength=len(number)), kind="stable")
            rank = np.empty(len(order), dtype=np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            listed = list(number)
            words = [listed[at].encode() for at in order]
            lengths = np.array([len(one) for one in codes], dtype="<u4")
            table = [(block, block, _pack_keys(keys), _pack(lengths), _pack_codes(rank[flat]), None, None)]
            slot = np.fromiter((_slot_of(word, slots) for word in words), dtype=np.int64, count=len(words))
            for which in np.unique(slot):
                at = np.flatnonzero(slot == which)
                table.append(
                    (-1 - int(which), block, None, None, None, _pack_ascending(at), _pack_ragged([words[i] for i in at]))
                )
            names = [part.split()[0] for part in _ROUTED.split(", ")]
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(column), type=kind) for column, kind in zip(zip(*table), kinds)], names=names
            )

        keys, codes, number, chars = [], [], {}, 0
        for batch in (part for whole in batches for part in pieces(whole)):
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = split(text)
                keys.append(key)
                codes.append(
                    np.fromiter((number.setdefault(w, len(number)) for w in found), dtype=np.uint32, count=len(found))
                )
                chars += len(text)
                if chars >= block_chars:
                    yield close(keys, codes, number)
                    keys, codes, number, chars = [], [], {}, 0
        if keys:
            yield close(keys, codes, number)
            keys, codes, number = [], [], {}
        give_back()

    return cut


def _pack_keys(keys: list[int | None]) -> bytes:
    """doc_ids with a flag for nulls."""
    return _pack(
        np.array([key is None for key in keys], dtype=np.uint8), np.array([key or 0 for key in keys], dtype="<i8")
    )


def _unpack_keys(packed: bytes) -> list[int | None]:
    count = len(packed) // 9
    missing = np.frombuffer(packed, np.uint8, count)
    return [None if gone else key for gone, key in zip(missing, np.frombuffer(packed, "<i8", count, count).tolist())]


def _encode_slot(path: str, pattern: str):
    def encode(table: pa.Table) -> pa.Table:
        if table.column("route")[0].as_py() >= 0:
            return pa.table({"block": pa.array([], pa.int64()), "ranks": pa.array([], pa.binary()), "ids": pa.array([], pa.binary())})
        piece = encoding(path, pattern)._encode_single_piece
        ids: dict[bytes, bytes] = {}
        out = []
        for packed in table.column("words").to_pylist():
            lengths, data = _unpack_ragged(packed)
            at, coded = 0, []
            for length in lengths.tolist():
                word = data[at : at + length]
                at += length
                known = ids.get(word)
                if known is None:
                    known = ids[word] = np.array(piece(word), dtype="<u4").tobytes()
                coded.append(known)
            out.append(_pack_ragged(coded))
        ids.clear()
        give_back()
        return pa.table(
            {
                "block": table.column("block"),
                "ranks": table.column("ranks"),
                "ids": pa.array(out, type=pa.binary()),
            }
        )

    return encode


def _assemble(body: pa.Table, coded: pa.Table) -> pa.Table:
    """One block: the ids of its words by rank, then those of its documents by position."""
    if not body.num_rows or body.column("route")[0].as_py() < 0:
        return pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})
    row = {name: body.column(name)[0].as_py() for name in ("doc_ids", "lengths", "codes")}
    keys, lengths, codes = _unpack_keys(row["doc_ids"]), np.frombuffer(row["lengths"], "<u4"), _unpack_codes(row["codes"])
    counts, flat, order = [], [], []
    for ranks, ids in zip(coded.column("ranks").to_pylist(), coded.column("ids").to_pylist()):
        sizes, data = _unpack_ragged(ids)
        order.append(_unpack_ascending(ranks))
        counts.append(sizes // 4)
        flat.append(np.frombuffer(data, "<u4"))
    empty = np.empty(0, np.int64)
    order, counts = np.concatenate([empty, *order]).astype(np.int64), np.concatenate([empty, *counts])
    flat = np.concatenate([np.empty(0, np.uint32), *flat]).astype(np.uint32)
    size, start = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    size[order], start[order] = counts, np.cumsum(counts) - counts
    word_ends = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
    taken = size[codes]
    ends = np.concatenate([[0], np.cumsum(taken)])
    ids = flat[_gather(start[codes], taken)]
    offsets = ends[word_ends]
    return pa.table(
        {
            "doc_id": pa.array(keys, type=pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(ids.astype(np.int32))),
        }
    )


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes of the runs [start, start + count), one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int64 if total >= 1 << 31 or (len(starts) and int(starts.max()) >= 1 << 31) else np.int32
    at = np.repeat((starts - (ends - counts)).astype(kind), counts)
    at += np.arange(total, dtype=kind)
    return at


def encode(
    docs: DataFrame, path: str, pattern: str, block_chars: int = BLOCK_CHARS, task_words: int = TASK_WORDS
) -> DataFrame:
    """doc_id and ids (array<int>) of every text, as tiktoken's ``encode_ordinary`` gives them.

    Null and empty texts have no ids; rows with equal doc_ids or texts each give a row; extra columns are
    dropped; no rows give no rows. A word of any length is one pre-token and is encoded in one piece. A document larger
    than ``block_chars`` is a block of its own.
    """
    return _put_together(docs, path, pattern, block_chars, task_words, _assemble, "doc_id long, ids array<int>")


def encode_digests(
    docs: DataFrame,
    path: str,
    pattern: str,
    keep_ids: bool = False,
    block_chars: int = BLOCK_CHARS,
    task_words: int = TASK_WORDS,
) -> DataFrame:
    """``digests(encode(...))``, with the digests made where a block is put together.

    A task that only hands its ids on to the next one needs two Python workers, and passes all ids through the JVM between them.
    """

    def finish(body: pa.Table, coded: pa.Table) -> pa.Table:
        encoded, table = _assemble(body, coded), token_bytes(path)
        parts = [part for whole in encoded.to_batches() for part in _parts(whole)]
        out = pa.Table.from_batches([_digest(part, table, keep_ids) for part in parts], _digest_kinds(keep_ids))
        give_back()
        return out

    return _put_together(docs, path, pattern, block_chars, task_words, finish, _DIGESTS + _IDS * keep_ids)


def _put_together(
    docs: DataFrame,
    path: str,
    pattern: str,
    block_chars: int,
    task_words: int,
    assemble: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    slots = max(SLOTS, _expected_words(docs) // task_words)
    # One exchange for documents and words, read twice as it is: every column goes to both readers.
    routed = texts.mapInArrow(_blocks(pattern, block_chars, slots), _ROUTED).repartition("route")
    coded = routed.groupBy("route").applyInArrow(_encode_slot(path, pattern), "block long, ranks binary, ids binary")
    return (
        routed.groupBy("route")
        .cogroup(coded.withColumnRenamed("block", "route").groupBy("route"))
        .applyInArrow(assemble, schema)
    )


def _expected_words(docs: DataFrame) -> int:
    """About how many (block, word) pairs there will be: a word per 64 bytes of text."""
    return (docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0) // 64


@lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table as (start, length, bytes); ids without a token have length 0."""
    ranks = rank_table(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    length = np.array([len(token) for token in tokens], dtype=np.int64)
    return np.cumsum(length) - length, length, np.frombuffer(b"".join(tokens), dtype=np.uint8)


def _decoded(flat: np.ndarray, offsets: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all lists of ids, and where each list's begin and end."""
    start, length, data = table
    taken = length[flat]
    ends = np.concatenate([[0], np.cumsum(taken)])
    return data[_gather(start[flat], taken)], ends[offsets]


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and bytes of every list of ids: a join with the token-byte table, whose size the vocabulary bounds.

    A null list gives no bytes; ids outside the vocabulary raise.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in (part for whole in batches for part in _parts(whole)):
            flat, offsets = _lists(batch.column("ids"))
            data, ends = _decoded(flat, offsets, table)
            buffer = data.tobytes()
            texts = [buffer[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, type=pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices with about ``DECODE_IDS`` ids, or one longer list."""
    sizes = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(sizes) // DECODE_IDS
    starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])


_DIGESTS, _IDS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", ", ids array<int>"


def _digest_kinds(keep_ids: bool) -> pa.Schema:
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    return pa.schema({**kinds, **({"ids": pa.list_(pa.int32())} if keep_ids else {})})


def _digest(batch: pa.RecordBatch, table, keep_ids: bool) -> pa.RecordBatch:
    flat, offsets = _lists(batch.column("ids"))
    ids, at = flat.astype("<u4").tobytes(), (4 * offsets).tolist()
    data, ends = _decoded(flat, offsets, table)
    data, ends = data.tobytes(), ends.tolist()
    sha = hashlib.sha256
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(np.diff(offsets)),
            pa.array([sha(ids[a:b]).hexdigest() for a, b in zip(at, at[1:])], type=pa.string()),
            pa.array([sha(data[a:b]).hexdigest() for a, b in zip(ends, ends[1:])], type=pa.string()),
            *([batch.column("ids")] if keep_ids else []),
        ],
        names=_digest_kinds(keep_ids).names,
    )


def digests(encoded: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded documents, decoding the ids through the token-byte table.

    ``keep_ids`` adds the ids themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in (part for whole in batches for part in _parts(whole)):
            yield _digest(batch, table, keep_ids)

    return encoded.select("doc_id", "ids").mapInArrow(run, _DIGESTS + _IDS * keep_ids)
