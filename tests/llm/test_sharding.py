import zlib
from collections import defaultdict

import pytest

from clipledger.llm.sharding import shard_by_bytes
from tests.llm.cases import SCHEMA, awkward, frame, real_rows


def check(rows, out, shards):
    assert len(out) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in out) == sorted(
        (k is None, k or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows
    )
    assert {r.law for r in out} <= {"bytes"} and all(r.grown_shard is None for r in out)
    per = defaultdict(list)
    for r in out:
        per[r.shard].append(r)
    largest, total = max(r.size for r in out), sum(r.size for r in out)
    for shard in range(shards):
        assert abs(sum(r.size for r in per[shard]) - total / shards) <= 2 * largest
        assert sorted(r.slot for r in per[shard]) == list(range(len(per[shard])))
    together = defaultdict(lambda: [0, set()])
    for r in out:
        together[r.text_crc32, r.size][0] += r.size
        together[r.text_crc32, r.size][1].add(r.shard)
    assert all(len(where) == 1 for size, where in together.values() if size <= largest)


@pytest.mark.parametrize("parts", [1, 7])
def test_real_documents(spark, parts):
    rows = [(row[0], row[1]) for row in real_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    check(rows, shard_by_bytes(docs, 4).collect(), 4)


def test_same_for_any_partitioning(spark):
    rows = [(row[0], row[1]) for row in real_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(shard_by_bytes(docs.repartition(1), 5).collect()) == sorted(shard_by_bytes(docs.repartition(9), 5).collect())


def test_awkward(spark):
    rows = awkward()
    check([(r[0], r[1]) for r in rows], shard_by_bytes(frame(spark, rows), 3).collect(), 3)


def test_a_group_that_is_most_of_the_rows_is_cut(spark):
    rows = [(i, "same text over and over") for i in range(300)] + [(i, f"other {i}") for i in range(300, 400)]
    out = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    check(rows, out, 4)


def test_empty(spark):
    out = shard_by_bytes(spark.createDataFrame([], SCHEMA))
    assert out.collect() == []
