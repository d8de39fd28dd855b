import hashlib
import random
import struct

import pytest
import tiktoken

from clipledger.llm import bpe
from clipledger.llm.queries import vocabulary
from clipledger.llm.support import rank_table
from tests.llm.cases import SCHEMA, awkward, frame, real_rows

PATH, PATTERN = vocabulary()


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=rank_table(PATH), special_tokens={})


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("block_chars, task_words", [(10_000, 50), (32_000_000, 2_000_000)])
def test_like_tiktoken(spark, plain, block_chars, task_words):
    rng = random.Random(5)
    odd = "aé \n\t'sS9٣東  ​\x1c\x85😀$%_ÀßЖ’"
    rows = awkward() + [(r[0] + 1000, r[1], "", 0, "", "", 0) for r in real_rows()]
    rows += [(5000 + k, "".join(rng.choice(odd) for _ in range(60)), "", 0, "", "", 0) for k in range(200)]
    encoded = bpe.encode(frame(spark, rows), PATH, PATTERN, block_chars, task_words)
    wanted = [(r[0], plain.encode_ordinary(r[1] or "")) for r in rows]
    assert order((r.doc_id, list(r.ids)) for r in encoded.collect()) == order(wanted)
    decoded = bpe.decode(encoded, PATH).collect()
    assert order((r.doc_id, bytes(r.bytes)) for r in decoded) == order((r[0], (r[1] or "").encode()) for r in rows)
    digests = bpe.digests(encoded, PATH).collect()
    assert order(tuple(r) for r in digests) == order(
        (
            key,
            len(ids),
            hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(plain.decode_bytes(ids)).hexdigest(),
        )
        for key, ids in wanted
    )


def test_empty(spark):
    assert bpe.encode(spark.createDataFrame([], SCHEMA), PATH, PATTERN).collect() == []


def test_null_lists_decode_to_nothing(spark):
    lists = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {tuple(r) for r in bpe.decode(lists, PATH).collect()} == {(1, b""), (2, b"")}


@pytest.mark.parametrize("keep_ids", [False, True])
def test_digests_need_no_second_python_task(spark, keep_ids):
    """Blocks are put together and digested by one worker; a second one beside it took the executor's memory."""
    rows = awkward()
    found = bpe.encode_digests(frame(spark, rows), PATH, PATTERN, keep_ids, 10_000, 50)
    wanted = bpe.digests(bpe.encode(frame(spark, rows), PATH, PATTERN, 10_000, 50), PATH, keep_ids)
    assert found.schema == wanted.schema
    assert order(tuple(r) for r in found.collect()) == order(tuple(r) for r in wanted.collect())

    def python_steps_at_the_end(frame):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        return plan[: plan.index("FlatMapCoGroupsInArrow")].count("MapInArrow")

    assert python_steps_at_the_end(found) == 0 and python_steps_at_the_end(wanted) == 1
    none = bpe.encode_digests(spark.createDataFrame([], SCHEMA), PATH, PATTERN, keep_ids)
    assert none.collect() == [] and none.schema == wanted.schema


def test_workers_give_back_what_they_no_longer_use():
    from clipledger.llm import support

    support.Words([b"a b" * 100_000], support.LOWER)
    assert len(support._POWERS.up) > 1
    support.give_back()
    assert len(support._POWERS.up) == len(support._POWERS.down) == 1
    words = support.Words([b"a b"], support.LOWER)
    assert words.text(0, 2) == "a b" and len(words.hashes) == 2
