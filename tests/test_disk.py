"""What lies on disk at once, and what is read or shuffled twice."""

import glob
import json
import time

from pyspark.sql import functions as F

from clipledger.operators.upsert import upsert_latest
from clipledger.plans import collect as C
from clipledger.plans import ingest
from clipledger.sources.landing import payload_scan
from clipledger.streaming import frontier
from clipledger.streaming.incremental import ingest_incremental
from tests.test_ingest import BOUNDS, contents, frame, landed_rows
from tests.test_plans import plan_of


def shuffled_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {path for folder in disk.localDirs() for path in glob.glob(f"{folder.getPath()}/*/shuffle_*.data")}


def test_shuffles_go_once_a_step_is_stored(spark, tmp_path):
    before = shuffled_files(spark)
    spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count().write.parquet(str(tmp_path / "stored"))
    until = time.time() + 20
    while (left := shuffled_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.read.parquet(str(tmp_path / "stored")).count() == 100


def test_a_result_can_be_collected_twice(spark):
    found = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().orderBy("k")
    assert found.collect() == found.collect()


def test_upsert_shuffles_hashes_as_bytes(spark):
    odd = ["0a" * 32, "0A" * 32, "0a" * 31, "0" * 63 + "\n", "g" * 64, "", None, "ff" * 33]
    shape = "key string, client string, author_hash string, day int"
    rows = spark.createDataFrame([(str(n), "c", text, day) for n, text in enumerate(odd) for day in (1, 2)], shape)
    newest = upsert_latest(None, rows, "key", order=("day",))
    plan = plan_of(newest)
    assert "unhex" in plan[plan.index("Exchange hashpartitioning"):]
    assert newest.columns == rows.columns and newest.dtypes == rows.dtypes
    assert sorted(newest.collect(), key=str) == sorted(rows.where("day = 2").collect(), key=str)
    assert upsert_latest(None, rows, "author_hash", order=("key", "day")).count() == len(odd)
    merged = upsert_latest(rows.where("day = 1"), rows.where("day = 2"), "key", order=("day",))
    assert sorted(merged.collect(), key=str) == sorted(newest.collect(), key=str)
    numbers = rows.withColumn("author_hash", F.col("day"))
    assert upsert_latest(None, numbers, "key", order=("day",)).dtypes == numbers.dtypes


def test_envelopes_are_read_in_one_walk(spark, tmp_path):
    odd = ['{"client":5,"page_seq":"x","body":{"a":1}}', '{"client":["a"],"http_status":200.0,"body":"{}"}', "[]", "{}", "null", '"x"', "3",
           '{"client":null,"page_seq":"7","fetched_at":"1970-01-02T00:00:00Z","body":null}', '{"client":"a","client":"b","fetched_at":1}']
    (tmp_path / "a.json").write_text("\n".join(odd))
    found = payload_scan(spark, str(tmp_path))
    plan = plan_of(found)
    assert "schema_of_variant" not in plan.lower() and plan.count("try_variant_get(parsed") == 1
    shown = found.select("client", "page_seq", "http_status", F.unix_seconds("fetched_at"), "body",
                         F.to_json("payload"), "broken.reason").collect()
    assert [tuple(row) for row in shown] == [
        ("5", None, None, None, None, '{"a":1}', None),
        ('["a"]', None, 200, None, "{}", None, None),
        (None, None, None, None, None, None, "not an object"),
        (None, None, None, None, None, None, None),
        (None, None, None, None, None, None, "not an object"),
        (None, None, None, None, None, None, "not an object"),
        (None, None, None, None, None, None, "not an object"),
        (None, 7, None, 86400, None, None, None),
        ("b", None, None, 1, None, None, None),
    ]


def test_waiting_pages_are_settled_once(spark, tmp_path, monkeypatch):
    """What a batch leaves for later is read from what it stored, without the joins that told it."""
    plans, finish = [], frontier.Batch.finish

    def noted(batch):
        plans.extend(plan_of(part) for part in batch.left)
        finish(batch)

    monkeypatch.setattr(frontier.Batch, "finish", noted)
    landing = tmp_path / "landing"
    landing.mkdir()
    rows = landed_rows()
    for number, part in enumerate((rows[::2], rows[1::2])):
        (landing / f"{number}.json").write_text("\n".join(map(json.dumps, part)))
    ingest_incremental(spark, str(landing), str(tmp_path / "root"), str(tmp_path / "state"), max_files_per_batch=1, **BOUNDS)
    assert len(plans) == 10 and not any("Join" in plan for plan in plans)
    ingest.ingest_sweep(spark, frame(spark, rows), str(tmp_path / "batch"), **BOUNDS)
    assert contents(spark, str(tmp_path / "root"))[1] == contents(spark, str(tmp_path / "batch"))[1]


def test_top_level_comments_are_stored_before_their_replies(spark, tmp_path):
    with ingest.staged_pages(spark, frame(spark, landed_rows())) as staged:
        videos = C.profile_videos(staged)
        stored = C.video_comments(staged, videos, include_replies=True, scratch=str(tmp_path / "scratch"))
        wanted = C.video_comments(staged, videos, include_replies=True)
        assert "endpoint=comments" not in plan_of(stored) and plan_of(stored).count("Window ") < plan_of(wanted).count("Window ")
        assert sorted(stored.collect(), key=str) == sorted(wanted.collect(), key=str)
        assert stored.count() == 42
