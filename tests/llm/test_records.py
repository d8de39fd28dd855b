import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clipledger.llm import records as R
from clipledger.llm.queries import QUERIES
from tests.llm.cases import SCHEMA, SMALL, awkward, frame, real_rows


def slow_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def model(rows):
    """doc_id, start, n_tokens, ids_crc32, plainly; null doc_ids last."""
    tokenizer = Tokenizer.from_file(R.word_vocabulary())
    coded = [(key, tokenizer.encode(text or "", add_special_tokens=False).ids + [2]) for key, text in rows]
    out, start = [], 0
    for key, ids in sorted(coded, key=lambda r: (r[0] is None, r[0] or 0)):
        out.append((key, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def plain(frame_):
    return sorted((tuple(r) for r in frame_.collect()), key=lambda r: r[1])


def test_checksums():
    assert R.crc32c([b"123456789"])[0] == 0xE3069283
    rng = random.Random(5)
    parts = [b"", b"\0", b"\0" * 700, *(rng.randbytes(rng.randrange(1500)) for _ in range(40))]
    assert R.crc32c(parts).tolist() == [slow_crc32c(part) for part in parts]
    assert R.masked(np.array([0xE3069283], np.uint32))[0] == (((0xE3069283 >> 15 | 0xE3069283 << 17) + 0xA282EAD8) & 0xFFFFFFFF)


def test_frames():
    payloads = [b"", b"abcd", bytes(1000)]
    records = R.framed(payloads)
    assert R.unframed(records) == payloads
    assert records[1][:8] == struct.pack("<Q", 4) and len(records[1]) == 4 + 16
    for at in (0, 9, 13, 18):
        broken = bytearray(records[1])
        broken[at] ^= 1
        with pytest.raises(ValueError):
            R.unframed([records[0], bytes(broken)])
    assert R.framed([]) == R.unframed([]) == []


def test_like_the_library(spark):
    """Unique ids: starts follow from doc_id alone."""
    rows = [(1000 + i, r[1]) for i, r in enumerate(awkward())] + [r[:2] for r in real_rows()]
    rows += [
        (5000, "a b c ́d 'S don't <|endoftext|> x<|startoftext|>y ΣΑΣ Σ \x1c\x1d z"),
        (5001, " ".join(f"w{i}" for i in range(3000))),
        (5002, "é" * 300 + " " + "ab" * 200 + "  \n\t end"),
    ]
    rng = random.Random(9)
    pool = "aΣ 'sé́ \t\n<|>1٣東 .,"
    rows += [(6000 + k, "".join(rng.choice(pool) for _ in range(rng.randrange(60)))) for k in range(200)]
    rng.shuffle(rows)
    docs = frame(spark, [(*row, "s", 1, "t", "k", 0) for row in rows])
    index = R.write_records(docs, R.word_vocabulary(), 2, file_bytes=20_000)
    assert plain(R.record_report(index)) == model(rows)
    assert index.select("file").distinct().count() > 8


def test_repeated_and_missing_ids(spark):
    rows = [r[:2] for r in awkward()] + [(None, "same")] * 40 + [(3, "other")] * 5
    found = plain(R.record_report(R.write_records(frame(spark, [(*r, "s", 1, "t", "k", 0) for r in rows]), R.word_vocabulary(), 2)))
    pairs = lambda out: sorted(((r[0] is None, r[0] or 0), r[2], r[3]) for r in out)
    assert pairs(found) == pairs(model(rows))
    total = 0
    for key, start, count, _ in found:
        assert start == total
        total += count
    ids = [r[0] for r in found]
    assert ids == sorted(ids, key=lambda key: (key is None, key or 0))


def test_shuffled_reads(spark):
    index = R.write_records(spark.createDataFrame([r[:2] for r in real_rows()], "doc_id long, text string"), R.word_vocabulary(), 2)
    once, again, other = ([r.doc_id for r in R.read_records(R.shuffled(index, seed)).collect()] for seed in (1, 1, 2))
    assert sorted(once) == sorted(again) == sorted(other) == sorted(r[0] for r in real_rows())
    first = [r.doc_id for r in R.shuffled(index, 1).collect()]
    assert first == [r.doc_id for r in R.shuffled(index, 1).collect()] != [r.doc_id for r in R.shuffled(index, 2).collect()]


def test_empty(spark):
    assert R.record_report(R.write_records(spark.createDataFrame([], SCHEMA), R.word_vocabulary(), 2)).collect() == []


def test_query(spark):
    assert plain(QUERIES["op13_records"](spark, SMALL)) == model([r[:2] for r in real_rows()])
