"""What several operators share: staged tables, tokenizers, words as byte strings, 64-bit hashing."""

from __future__ import annotations

import base64
import ctypes
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.session import scratch_dir
from clipledger.sources import files

NAME_PREFIX = "__llm_"
#: Whether Spark drops the shuffle files of a query once it has ended.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the folder all executors share, and read it back.

    Cuts the lineage: whatever is lost later is read again from the written table, so the shuffles that led to it go at once.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, name)
    for made in _recording:
        made.append(path)
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    stored = spark.read.schema(frame.schema).parquet(path)
    stored.staged_at = path
    return stored


#: Lists that open ``recorded`` blocks keep of staged folders.
_recording: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Notes the folders that ``stage`` writes meanwhile, so that they can be removed once nothing reads them."""
    made: list[str] = []
    _recording.append(made)
    try:
        yield made
    finally:
        _recording.remove(made)


def discard(*staged: DataFrame) -> None:
    """Remove tables made by ``stage`` that no later step reads: what came of them has been staged itself."""
    for frame in staged:
        at = vars(frame).get("staged_at")
        for folder in [at] if at else {path.rsplit("/", 1)[0] for path in frame.inputFiles()}:
            files.remove(frame.sparkSession, folder)


def hidden(name: str) -> str:
    """A column name that a caller's table won't hold."""
    return NAME_PREFIX + name


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def text_key(column: str | Column = "text") -> Column:
    """128 bits that stand for a text; null counts as its own text."""
    text = F.col(column) if isinstance(column, str) else column
    missing = text.isNull()
    return F.struct(
        F.xxhash64(F.coalesce(text, F.lit("")), missing).alias("a"),
        F.xxhash64(F.lit(7), F.length(text), F.coalesce(text, F.lit(""))).alias("b"),
    )


def give_back() -> None:
    """Hands memory that freed arrays and batches have left to the system.

    Python workers are used again by later stages, and several run beside one JVM: what each of them keeps adds up.
    """
    _POWERS.up = _POWERS.down = np.ones(1, np.uint64)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


@lru_cache(maxsize=4)
def rank_table(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The tiktoken encoding of a rank file, one per worker process."""
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=rank_table(path), special_tokens={})


def utf8_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


#: A-Z to a-z, white space to blanks.
LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


#: Bytes of text that are hashed at a time; a longer text makes a larger piece.
PIECE_BYTES = 1 << 21
#: Bytes of a word beyond which it has a hash of its own kind.
LONG_WORD = 64
_STEP = 0x9E3779B97F4A7C15 & ~7 | 5  # 5 modulo 8: its powers differ in as many bits as can be
_BACK = pow(_STEP, -1, 1 << 64)
# A value per byte, none for blanks.
_BYTE_VALUES = np.array([xxhash.xxh3_64_intdigest(bytes([b]), seed=17) | 1 for b in range(256)], dtype=np.uint64)
_BYTE_VALUES[32] = 0


class Powers:
    """Powers of the step and of its inverse modulo 2 ** 64, as far as they were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, count: int) -> None:
        if count > len(self.up):
            ups, downs = np.full(count, _STEP, np.uint64), np.full(count, _BACK, np.uint64)
            ups[0] = downs[0] = 1
            self.up, self.down = np.cumprod(ups), np.cumprod(downs)


_POWERS = Powers()


class Words:
    """The words of several texts: 64-bit hashes, end to end, and where each text's begin and end.

    ``table`` maps bytes; those that map to a blank separate words. A hash is the sum over the word's bytes of a value of the byte
    times a power for its position, from running sums over the whole piece.
    """

    def __init__(self, texts: list[bytes | None], table: bytes):
        self.data = b"\n".join([text or b"" for text in texts]).translate(table) + b" "
        codes = np.frombuffer(self.data, np.uint8)
        word = np.empty(len(codes) + 1, dtype=np.int8)
        word[0] = 0
        word[1:] = codes != 32
        turns = np.diff(word)
        self.starts, self.ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        _POWERS.reach(len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[codes] * _POWERS.up[: len(codes)], out=sums[1:])
        self.hashes = mixed((sums[self.ends] - sums[self.starts]) * _POWERS.down[self.starts])
        # Sums of so many powers modulo 2 ** 64 can be made to agree; long words are hashed one by one.
        for at in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist():
            self.hashes[at] = xxhash.xxh3_64_intdigest(self.data[self.starts[at] : self.ends[at]], seed=29)
        sizes = np.array([len(text or b"") + 1 for text in texts], dtype=np.int64)
        borders = np.cumsum(sizes)
        self.to = np.searchsorted(self.starts, borders)
        self.since = np.concatenate([[0], self.to[:-1]]).astype(np.int64)

    def text(self, first: int, last: int) -> str:
        """Words first to last - 1, one blank between any two."""
        return b" ".join(self.data[self.starts[first] : self.ends[last - 1]].split()).decode()


def pieces(batch: pa.RecordBatch, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each, or one larger text."""
    sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(sizes) // limit
    starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


#: Odd multipliers of a gram's words, from the golden ratio and powers of an odd number.
_POSITIONS = [pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(64)]


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for every run of ``k`` word hashes."""
    count = len(hashes) - k + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(k):
        total += hashes[i : i + count] * np.uint64(_POSITIONS[i])
    return mixed(total)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; equal in, equal out, and nothing else."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
