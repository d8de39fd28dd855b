"""Token ids as length-delimited binary records, with an offset index beside them.

A record is the frame that TFRecord readers know: the payload's length (64 bits), a masked CRC-32C of these eight bytes, the
payload, a masked CRC-32C of the payload; all little-endian. The payload is a byte that gives the width of an id, 2 or 4 bytes as
the vocabulary needs, and the document's ids as unsigned integers of that width, the end id included. Files follow one another in
order of doc_id. The index is a table of its own that names file, offset and length of every record, so that records can be read
in any order.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipledger.llm.support import hidden, pieces, stage
from clipledger.session import scratch_dir

#: Bytes after which a task begins a new file, and bytes read at once.
FILE_BYTES = 256 << 20
SPAN_BYTES = 4 << 20
HEADER, FOOTER = 12, 4
#: Ranges whose totals are added up together.
RANGES_TOGETHER = 1024
#: Chunks of text whose ids a worker remembers, in each of two generations, and characters of the longest one.
REMEMBERED = 400_000
LONGEST_CHUNK = 64
#: New chunks that are encoded as one text, and signs that are told from the letters before them.
TOGETHER = 1000
SIGNS = ".,;:!?*#$%&|"

# CRC-32C: the reversed polynomial, and the constant that masks it in record files (fixed values).
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
_WIDTH = 256  # bytes of a chunk whose checksum is taken in one sweep


def _byte_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(POLYNOMIAL), values >> 1)
    return values


_TABLE = _byte_table()


@lru_cache(maxsize=64)
def _zeros(power: int) -> np.ndarray:
    """What 2 ** power zero bytes make of a register: a table for each of its four bytes."""
    lanes = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    if power == 0:
        return _TABLE[lanes & 0xFF] ^ (lanes >> 8)
    return _moved(_moved(lanes, power - 1), power - 1)


def _moved(states: np.ndarray, power: int) -> np.ndarray:
    by = _zeros(power)
    return by[0][states & 0xFF] ^ by[1][(states >> 8) & 0xFF] ^ by[2][(states >> 16) & 0xFF] ^ by[3][states >> 24]


def _shifted(states: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Registers after so many zero bytes each."""
    states = states.copy()
    for power in range(int(count.max(initial=0)).bit_length()):
        chosen = (count >> power) & 1 == 1
        states[chosen] = _moved(states[chosen], power)
    return states


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of every part. Registers are linear: chunks are swept side by side, then moved to their places and added."""
    sizes = np.array([len(part) for part in parts], dtype=np.int64)
    chunks = np.maximum(-(-sizes // _WIDTH), 1)
    ends = np.cumsum(chunks)
    # Zeros in front leave an empty register empty, so each part is filled up at its front.
    filled = b"".join(bytes(int(n) * _WIDTH - len(part)) + part for n, part in zip(chunks, parts))
    grid = np.ascontiguousarray(np.frombuffer(filled, np.uint8).reshape(-1, _WIDTH).T)
    states = np.zeros(grid.shape[1], np.uint32)
    for column in grid:
        states = _TABLE[(states ^ column) & 0xFF] ^ (states >> 8)
    behind = np.repeat(ends, chunks) - 1 - np.arange(len(states))
    whole = np.bitwise_xor.reduceat(_shifted(states, behind * _WIDTH), ends - chunks)
    return whole ^ _shifted(np.full(len(parts), 0xFFFFFFFF, np.uint32), sizes) ^ np.uint32(0xFFFFFFFF)


def masked(checksums: np.ndarray) -> np.ndarray:
    """Rotated and shifted, so that a checksum of bytes that hold checksums is no special case."""
    return ((checksums >> 15) | (checksums << 17)) + np.uint32(MASK_DELTA)


def framed(payloads: list[bytes]) -> list[bytes]:
    """A record for every payload."""
    if not payloads:
        return []
    heads = [len(payload).to_bytes(8, "little") for payload in payloads]
    marks = masked(crc32c(heads)).astype("<u4").tobytes(), masked(crc32c(payloads)).astype("<u4").tobytes()
    return [
        head + marks[0][4 * k : 4 * k + 4] + payload + marks[1][4 * k : 4 * k + 4]
        for k, (head, payload) in enumerate(zip(heads, payloads))
    ]


def unframed(records: list[bytes]) -> list[bytes]:
    """The payloads; ValueError if a length or a checksum doesn't fit."""
    if not records:
        return []
    payloads = [record[HEADER:-FOOTER] for record in records]
    if framed(payloads) != records:
        damaged = next(k for k, (record, payload) in enumerate(zip(records, payloads)) if framed([payload]) != [record])
        raise ValueError(f"record {damaged} of a batch of {len(records)} is damaged")
    return payloads


class Encoder:
    """Ids of whole texts by the tokenizers library, each different chunk between blanks only once while it is remembered.

    White space separates words in this vocabulary's rules and leaves nothing behind, so a text's ids are those of its chunks in
    order. New chunks that are plain words are encoded many at a time: a token that ends a word shows where one ends.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out already
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ending = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ending[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _alone(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(one.ids, self.kind).tobytes() for one in found]

    def _together(self, chunks: list[str]) -> list[bytes]:
        """Chunks of letters, so each is one word at least. If there are no more in all, each is just one."""
        out: list[bytes] = []
        for at in range(0, len(chunks), TOGETHER):
            some = chunks[at : at + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.ending[ids]) + 1
            if len(ends) != len(some):
                out += self._alone(some)
                continue
            data, places = ids.tobytes(), (ends * self.width).tolist()
            out += [data[a:b] for a, b in zip([0, *places], places)]
        return out

    def _learn(self, chunks: set[str]) -> None:
        """Ids of chunks, from the generation before or from the library. Signs behind letters are words of their own."""
        young, old = self.young, self.old
        signed = []
        wanted = set()
        for chunk in chunks:
            known = old.get(chunk)
            if known is not None:
                young[chunk] = known
                continue
            body = chunk.rstrip(SIGNS)
            if len(body) < len(chunk) and body.isalpha():
                signed.append((chunk, body, chunk[len(body) :]))
                wanted.add(body)
                wanted.add(chunk[len(body) :])
            else:
                wanted.add(chunk)
        plain, others = [], []
        for chunk in wanted.difference(young):
            known = old.get(chunk)
            if known is not None:
                young[chunk] = known
            elif chunk.isalpha():
                plain.append(chunk)
            else:
                others.append(chunk)
        young.update(zip(plain, self._together(plain)))
        young.update(zip(others, self._alone(others)))
        young.update([(chunk, young[body] + young[sign]) for chunk, body, sign in signed])

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text, ``width`` bytes each."""
        texts = pc.replace_substring(texts.fill_null(""), "\n", " ")
        split = pc.split_pattern(texts, " ")
        chunks = split.flatten().dictionary_encode()
        different = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        unknown = set(different).difference(self.young)
        self._learn(unknown)
        parts = [self.young[chunk] for chunk in different]
        for chunk in unknown:
            if len(chunk) > LONGEST_CHUNK:
                del self.young[chunk]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        # All ids in order: those of each chunk are copied from its part.
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // self.width
        starts = np.cumsum(sizes) - sizes
        which = chunks.indices.to_numpy()
        ends = np.cumsum(sizes[which])
        shift = starts[which] - (ends - sizes[which])
        total = int(ends[-1]) if len(ends) else 0
        flat = np.frombuffer(b"".join(parts), self.kind)
        ids = flat[np.repeat(shift, sizes[which]) + np.arange(total)].tobytes()
        borders = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()] * self.width
        return [ids[a:b] for a, b in zip(borders.tolist(), borders[1:].tolist())]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


INDEX = "doc_id long, file string, offset long, length long, n_tokens long, `range` int, before long"


def _writer(folder: str, path: str, end_id: int, file_bytes: int):
    """Encodes and writes sorted documents; yields index rows. A task that is run again writes files of other names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        coder = encoder(path)
        first, ending = bytes([coder.width]), int(end_id).to_bytes(coder.width, "little")
        system, base = _opened(folder)
        sink, name, at, before, count = None, "", 0, 0, 0
        for batch in batches:
            for part in pieces(batch):
                payloads = [first + ids + ending for ids in coder.encode(part.column("text"))]
                rows = []
                for payload, record in zip(payloads, framed(payloads)):
                    if sink is None or at >= file_bytes:
                        if sink is None:
                            system.create_dir(base, recursive=True)
                        else:
                            sink.close()
                        name, at, count = f"ids-{number:06d}-{count:04d}-{attempt}.rec", 0, count + 1
                        sink = system.open_output_stream(f"{base}/{name}")
                    sink.write(record)
                    tokens = (len(payload) - 1) // coder.width
                    rows.append((f"{folder}/{name}", at, len(payload), tokens, number, before))
                    at += len(record)
                    before += tokens
                columns = list(zip(*rows))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(values, kind) for values, kind in zip(columns, kinds))],
                    names=["doc_id", "file", "offset", "length", "n_tokens", "range", "before"],
                )
        if sink is not None:
            sink.close()

    return run


def write_records(docs: DataFrame, path: str, end_id: int, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode every text, append ``end_id``, write the records in order of doc_id; returns the stored index.

    Index: doc_id, file, offset, length (of the payload), n_tokens, range (a task's part of the order), before (ids of
    the range in front of the record). Null texts count as empty, so each record has one id at least. Null doc_ids come
    last; rows of one doc_id are ordered by a hash of the text, and equal rows each get a record. No rows give no files.
    Other columns are ignored.

    ``folder`` is written by tasks, by whatever pyarrow reaches (a shared mount, HDFS, S3, GCS); by default it is a new one
    in the shared folder of the session. Only files named in the index count: a lost task leaves files behind that nothing names.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "records")
    key, row = hidden("key"), hidden("row")
    # The row's own number lets equal rows go to different ranges.
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias(key), F.monotonically_increasing_id().alias(row)
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col(key), F.col(row)]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return stage(dealt.mapInArrow(_writer(folder, path, end_id, file_bytes), INDEX), "record_index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: ids of all records before it, from totals of ranges."""
    together = F.floor(F.col("range") / RANGES_TOGETHER)
    totals = index.groupBy("range").agg(F.sum("n_tokens").alias("total")).withColumn("together", together)
    inside = Window.partitionBy("together").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.orderBy("together").rowsBetween(Window.unboundedPreceding, -1)  # a row for every 1,024 ranges
    groups = totals.groupBy("together").agg(F.sum("total").alias("all")).select(
        "together", F.coalesce(F.sum("all").over(above), F.lit(0)).alias("first")
    )
    firsts = totals.withColumn("earlier", F.coalesce(F.sum("total").over(inside), F.lit(0))).join(groups, "together")
    firsts = firsts.select("range", (F.col("first") + F.col("earlier")).alias("first"))
    return index.join(firsts, "range").withColumn("start", F.col("first") + F.col("before")).drop("first")


def _spans(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """Records that lie side by side, as (file, offset, bytes, places in ``rows``)."""
    order = sorted(range(len(rows)), key=lambda k: rows[k][:2])
    span: list[int] = []
    for k in order:
        file, offset, length = rows[k]
        if span and (rows[span[0]][0] != file or end != offset or end - rows[span[0]][1] >= SPAN_BYTES):
            yield rows[span[0]][0], rows[span[0]][1], end - rows[span[0]][1], span
            span = []
        span.append(k)
        end = offset + HEADER + length + FOOTER
    if span:
        yield rows[span[0]][0], rows[span[0]][1], end - rows[span[0]][1], span


def _reader(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(name).to_pylist() for name in ("file", "offset", "length"))))
            opened = (None, None)
            for file, offset, size, places in _spans(rows):
                if opened[0] != file:
                    if opened[1] is not None:
                        opened[1].close()
                    system, base = _opened(file)
                    opened = (file, system.open_input_file(base))
                data = opened[1].read_at(size, offset)
                cuts = [rows[k][1] - offset for k in places]
                records = [data[at : at + HEADER + rows[k][2] + FOOTER] for at, k in zip(cuts, places)]
                part = batch.take(pa.array(places, pa.int64()))
                ids = [np.frombuffer(load, f"<u{load[0]}", offset=1).astype("<u4").tobytes() for load in unframed(records)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in keep), pa.array(ids, pa.binary())],
                    names=[*keep, "ids"],
                )
            if opened[1] is not None:
                opened[1].close()

    return run


def read_records(index: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of index rows and ``ids``, unsigned 32-bit integers, read from the files; every checksum is verified.

    Rows may come in any order: those of a batch that lie side by side in a file are read at once. A damaged or cut
    record fails the job.
    """
    kinds = dict(index.dtypes)
    schema = ", ".join([*(f"`{name}` {kinds[name]}" for name in keep), "ids binary"])
    return index.select("file", "offset", "length", *(name for name in keep if name not in ("file", "offset", "length"))).mapInArrow(
        _reader(list(keep)), schema
    )


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """Index rows in an order that ``seed`` alone decides: another one for every epoch of training."""
    at = F.xxhash64(F.lit(seed), "range", "before")
    return index.repartitionByRange(at).sortWithinPartitions(at)


def record_report(index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record, read back from the files."""
    read = read_records(with_starts(index), ("doc_id", "start"))
    return read.select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def word_vocabulary() -> str:
    """Path of the public vocabulary with word ends. LLM_WORDS names another file."""
    import public_tokenizers

    return os.environ.get("LLM_WORDS") or public_tokenizers.path("word_bpe_49k.json")
