import hashlib
import random

import pytest
from pyspark.sql import functions as F

from clipledger.llm import warc as W
from clipledger.llm.queries import QUERIES
from tests.llm.cases import real_rows

INDEX = "file string, offset long, length long, leaf string"


def index(spark, rows):
    return spark.createDataFrame(rows, INDEX)


def archive(seed, files=3, count=400):
    rng, out = random.Random(seed), []
    for f in range(files):
        at = 0
        for k in range(count):
            size = rng.randrange(200, 6000)
            out.append((f"f{f}", at, size, hashlib.sha256(f"{seed}{f}{k}".encode()).hexdigest()))
            at += size
    return out


def test_damage_is_found(spark):
    left, rng = archive(1), random.Random(2)
    right, wanted = [], []
    for row in left:
        kind = rng.randrange(120)
        if kind == 0:
            wanted.append((*row[:2], "missing"))
        elif kind == 1:
            right.append((*row[:3], "0" * 64))
            wanted.append((*row[:2], "corrupt"))
        elif kind == 2:
            right += [row, (row[0], row[1] + 1, 5, "1" * 64)]
            wanted.append((row[0], row[1] + 1, "extra"))
        else:
            right.append(row)
    found = W.audit(index(spark, left), index(spark, right)).collect()
    assert sorted((r.file, r.offset, r.status) for r in found) == sorted(wanted) and len(wanted) > 10


def test_equal_replicas(spark):
    rows = archive(3, files=1, count=50)
    shuffled = random.Random(1).sample(rows, len(rows))
    assert W.audit(index(spark, rows), index(spark, shuffled)).collect() == []


def test_a_missing_file_and_empty_tables(spark):
    rows = archive(4, files=2, count=5)
    found = W.audit(index(spark, rows), index(spark, rows[:5])).collect()
    assert sorted((r.file, r.offset) for r in found) == [r[:2] for r in rows[5:]] and {r.status for r in found} == {"missing"}
    assert {r.status for r in W.audit(index(spark, []), index(spark, rows)).collect()} == {"extra"}
    assert W.audit(index(spark, []), index(spark, [])).collect() == []


def test_only_differing_branches_are_opened(spark):
    left = archive(5, files=1, count=600)
    right = [row if k != 300 else (*row[:3], "x") for k, row in enumerate(left)]
    levels = W._levels(index(spark, left))
    trees = [W.tree(index(spark, rows), levels) for rows in (left, right)]
    for a, b in zip(*trees):
        assert a.join(b, ["file", "at", "hash"], "left_anti").count() == 1
    assert trees[0][-1].count() == 1 and trees[0][0].count() > 20


def test_archive_index(spark):
    rows = [(r[0], r[1], r[2]) for r in real_rows("pages")] + [(None, None, None), (7, "u", "é"), (7, "u", "é")]
    pages = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, offset int")
    found = W.archive_index(pages).orderBy("offset").collect()
    at = 0
    for r in found:
        assert r.offset == at
        at += r.length
    assert [r.record_id for r in found] == sorted([r[0] for r in rows], key=lambda k: (k is not None, k or 0))
    assert W.archive_index(pages.where("false")).collect() == []


@pytest.mark.parametrize("packed", [False, True])
def test_read_index(spark, tmp_path, packed):
    pages = spark.createDataFrame([(1, "http://a/b", "<p>x</p>"), (2, "http://a/c", None), (3, None, "é" * 500)], "page_id long, url string, html string")
    records = [bytes(r.b) for r in pages.orderBy("page_id").select(W.record_bytes(F.col("url"), F.col("page_id"), F.col("html")).alias("b")).collect()]
    stored = [W.write_member(record) if packed else record for record in records]
    (tmp_path / "a.warc").write_bytes(b"".join(stored))
    (tmp_path / "b.warc").write_bytes(b"not a record")
    (tmp_path / "c.warc").write_bytes(b"")
    found = W.read_index(spark, str(tmp_path)).collect()
    mine = sorted((r.offset, r.length, r.leaf) for r in found if r.file.endswith("a.warc"))
    ends = [sum(map(len, stored[: k + 1])) for k in range(3)]
    assert mine == [(e - len(s), len(s), hashlib.sha256(r).hexdigest()) for e, s, r in zip(ends, stored, records)]
    assert len([r for r in found if r.file.endswith("b.warc")]) == 1 and not [r for r in found if r.file.endswith("c.warc")]


@pytest.mark.parametrize("packed", [False, True])
def test_a_broken_record_hides_no_other(packed):
    rng = random.Random(6)
    head = "WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: "
    records = []
    for k in range(20):
        body = "".join(rng.choice("abcdefgh \n") for _ in range(300 + k))
        records.append(f"{head}{len(body)}\r\n\r\n{body}\r\n\r\n".encode())
    stored = [W.write_member(record) if packed else record for record in records]
    content = b"".join(stored)
    whole = W.record_spans(content)
    assert len(whole) == 20
    starts = [at for at, _, _ in whole]
    length_at = len(head)
    for broken in (0, 7, 19):
        for inside in (0, 1, 40, length_at, len(stored[broken]) - 2):
            at = starts[broken] + inside
            for new in (b"\x00", b"9"):
                found = W.record_spans(content[:at] + new + content[at + 1 :])
                assert [f for k, f in enumerate(found) if k != broken] == [w for k, w in enumerate(whole) if k != broken]
                assert found[broken][:2] == whole[broken][:2]


def test_op10_damages_rows_not_ids(spark, tmp_path):
    """Rows with one id are damaged each, and a page without an id is not lost."""
    rows = [(7, "u", "one"), (7, "u", "two"), (3, "u", "x"), (None, "u", "y"), (8, "u", "z")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = QUERIES["op10_warc"](spark, str(tmp_path)).collect()
    assert sorted(r.status for r in found) == ["corrupt", "corrupt", "missing"]
    sha = lambda one: hashlib.sha256(one).hexdigest()
    record = lambda k, body: (
        f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{k}>\r\nWARC-Target-URI: u\r\n"
        f"Content-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
    ).encode()
    pairs = {(sha(record(7, "one")), sha(record(7, "on~"))), (sha(record(7, "two")), sha(record(7, "tw~")))}
    assert {(r.left_leaf, r.right_leaf) for r in found if r.status == "corrupt"} == pairs
