"""What grows with the input: shuffles that carry text, tasks, and work done twice."""

import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clipledger.fixtures import raw as R
from clipledger.operators import paging as P
from clipledger.operators.upsert import upsert_latest
from clipledger.plans import collect as C
from clipledger.plans.collect import under_parsed_ids
from clipledger.queries import QUERIES
from clipledger.sources.contracts import COMMENT_KEY, COMMENT_SCHEMA
from clipledger.sources.landing import from_envelopes
from clipledger.sources.tables import append_rows, current_table
from tests.test_plans import SF_DIR, plan_of


@pytest.mark.parametrize("pages, shuffles", [
    (R.comment_pages, 2), (R.thread_comment_pages, 2), (R.reply_pages, 2), (R.profile_pages, 1),
])
def test_pages_are_made_where_their_rows_are(spark, pages, shuffles):
    """Two inputs or one, each shuffled once before its rows become text."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(pages(spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("Exchange hashpartitioning") == shuffles
    assert "to_json" not in plan[plan.index("Exchange hashpartitioning"):]


def test_tasks_follow_the_size_of_a_table(spark):
    assert R.table(spark, SF_DIR, "orders").rdd.getNumPartitions() <= 8
    assert R.table(spark, SF_DIR, "orders", 1 << 10).rdd.getNumPartitions() > 8


def test_reports_parse_once(spark):
    assert "parse_json" not in plan_of(QUERIES["thread_rows"](spark, SF_DIR)).lower().replace("parsejson", "parse_json")


def test_items_are_joined_only_where_an_id_changed(spark):
    collected = spark.createDataFrame([("r", "c", "1", "x"), ("r", "c", "2", "y")], "run_id string, client string, video_id string, item string")
    shape = "run_id string, client string, video_id string, parsed_id string"
    same = spark.createDataFrame([("r", "c", "1", "1"), ("r", "c", "2", "2"), ("r", "c", None, "2")], shape)
    moved = same.unionByName(spark.createDataFrame([("r", "c", "2", "0"), ("r", "c", "2", "1")], shape))
    assert "Join" not in plan_of(under_parsed_ids(collected, same))
    assert under_parsed_ids(collected, same).collect() == collected.collect()
    found = under_parsed_ids(collected, moved).select("item", "video_id").orderBy(F.col("item")).collect()
    assert [tuple(row) for row in found] == [("x", "1"), ("y", "0")]


@pytest.mark.parametrize("name", ["page_stitch", "first_seen", "reply_expand_threads"])
def test_pages_are_built_once(spark, name):
    """Stitching reads pages twice, so they are stored first."""
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "collect_list" not in plan and "lineitem" not in plan


def test_sorts_begin_with_what_tells_rows_apart(spark, documents):
    items = documents('{"cid":"a"}').select(*[F.lit("r").alias(name) for name in P.REQUEST], "item", F.lit(1).alias("ord"))
    assert "Sort [_key" in plan_of(P.first_seen(items, ("cid", "id")))
    rows = spark.createDataFrame([("c", "1", 1)], "client string, video_id string, collected_at int")
    assert "Sort [video_id" in plan_of(upsert_latest(None, rows, "video_id"))


def test_keys_of_odd_ids(documents):
    texts = ['{"cid":5}', '{"cid":"5"}', '{"cid":0,"id":"a"}', '{"cid":null,"id":null}', '{"cid":"","id":"null"}', '{"cid":{}}',
             '{"cid":[1],"id":2}', '[1]', '"x"', "{}", '{"id":0}', '{"cid":"0","id":1}']
    items = documents(*texts).select("*", F.lit("r").alias("run_id"))
    for keys in (("cid", "id"), ("id", "cid"), ("cid", "cid"), ("CID", "cid")):
        place = F.concat(F.lit("#/"), F.col("n").cast("string"))
        wanted = items.select("n", F.coalesce(F.to_json(P.item_id(F.col("item"), keys)), place))
        found = P.first_keyed(items, keys, ("n",), ("n",)).select("n", "_key")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


SHAPE = (
    "run_id string, endpoint string, client string, video_id string, parent_comment_id string, page_seq int, "
    "request_cursor bigint, http_status int, body string, fetched_at timestamp"
)


def staged_comments(spark, folder, *requests):
    """Comment pages of (run, video, day, ids of each page) as staged, and the videos asked for."""
    rows = [
        (run, "comments", "c", video, None, seq, 3 * seq, 200,
         json.dumps({"comments": [{"cid": one, "text": f"{run}{video}{one!r}"} for one in ids], "has_more": 1, "cursor": 3 * seq + 3}),
         datetime(2024, 1, day))
        for run, video, day, pages in requests for seq, ids in enumerate(pages)
    ]
    C.write_staged(from_envelopes(spark.createDataFrame(rows, SHAPE)), folder)
    asked = sorted({(run, "c", video, video) for run, video, _, _ in requests})
    videos = spark.createDataFrame(asked, "run_id string, client string, requested_id string, video_id string")
    return C.read_staged(spark, folder), videos


LONE = ("r", "1", 1, [["a", "b", "a"], ["a", None, "c"]])


@pytest.mark.parametrize("others", [
    [("r", "2", 2, [["d"]])],
    [("r", "2", 2, [["d", "a"]])],
    [("r", "2", 1, [["c", "b"], [], ["x"]]), ("s", "1", 3, [["a"]])],
    [("r", "2", 2, [[5, "5", 5.0]])],
])
@pytest.mark.parametrize("few_bytes", [P.FEW_BYTES, 0])
def test_newest_comments_by_hash_are_the_newest(spark, tmp_path, monkeypatch, others, few_bytes):
    monkeypatch.setattr(P, "FEW_BYTES", few_bytes)
    staged, videos = staged_comments(spark, str(tmp_path / "staged"), LONE, *others)
    comments = C.video_comments(staged, videos)
    found = C.newest_comments(comments, staged, False, str(tmp_path / "scratch"))
    wanted = C.one_per_comment(comments)
    assert found.columns == wanted.columns
    assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str)


def test_comments_of_one_video_need_no_second_shuffle(spark, tmp_path):
    staged, videos = staged_comments(spark, str(tmp_path / "staged"), LONE, ("r", "2", 2, [["d"]]))
    comments = C.video_comments(staged, videos)
    found = C.newest_comments(comments, staged, False, str(tmp_path / "scratch"))
    assert plan_of(found).count("Window ") == plan_of(comments).count("Window ")


def test_pages_are_joined_once(spark, tmp_path):
    """Which pages count is settled from the paging fields; then one join reads the items."""
    staged, videos = staged_comments(spark, str(tmp_path / "staged"), LONE)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(C.video_comments(staged, videos))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    lines = plan.splitlines()
    scans = [at for at, line in enumerate(lines) if re.search(r"FileScan.*\bitems#", line)]
    assert len(scans) == 1
    above, depth = [], len(lines[scans[0]])
    for line in reversed(lines[: scans[0] + 1]):
        if len(line) - len(line.lstrip(" :+-")) < depth:
            above.append(line)
            depth = len(line) - len(line.lstrip(" :+-"))
    assert sum("SortMergeJoin" in line for line in above) == 1
    assert sorted(row.comment_id for row in C.video_comments(staged, videos).collect()) == ["a", "b", "c"]


def test_one_added_version_is_read_as_it_is(spark, tmp_path):
    rows = spark.createDataFrame([("a", "v", "c"), (None, "v", "c")], "comment_id string, video_id string, client string")
    append_rows(spark, rows, str(tmp_path), COMMENT_SCHEMA, "one")
    table = current_table(spark, str(tmp_path), COMMENT_SCHEMA, COMMENT_KEY)
    assert "Window" not in plan_of(table) and table.count() == 2
    append_rows(spark, rows, str(tmp_path), COMMENT_SCHEMA, "two")
    assert current_table(spark, str(tmp_path), COMMENT_SCHEMA, COMMENT_KEY).count() == 2


@pytest.mark.parametrize("pages", [R.comment_pages, R.profile_pages])
def test_rows_are_not_spread_before_they_are_shuffled(spark, pages):
    assert "RoundRobin" not in plan_of(pages(spark, SF_DIR))


def test_hashes_are_stored_as_they_were(spark, tmp_path):
    odd = ["0a" * 32, "0A" * 32, "0a" * 31, "0a" * 32 + "\n", "0" * 63 + "\n", "g" * 64, "", None, "ff" * 33]
    rows = [(str(n), "v", "c", text) for n, text in enumerate(odd)]
    table = spark.createDataFrame(rows, "comment_id string, video_id string, client string, author_hash string")
    found = append_rows(spark, table, str(tmp_path), COMMENT_SCHEMA, "one")
    assert [row.author_hash for row in sorted(found.collect(), key=lambda row: int(row.comment_id))] == odd
