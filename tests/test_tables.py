from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipledger.operators.resolve import require_resolved, resolve_handles
from clipledger.sources import files, tables
from clipledger.sources.contracts import COMMENT_KEY, COMMENT_SCHEMA, VIDEO_SCHEMA
from clipledger.sources.registry import registry_scan


def comments(spark, *rows):
    """Comment rows from (comment_id, client, like_count, day)."""
    narrow = spark.createDataFrame(list(rows), "comment_id string, client string, like_count long, day int")
    return tables.to_contract(
        narrow.withColumn("collected_at", F.timestamp_seconds(F.col("day") * 86400)).withColumn(
            "video_id", F.lit("v")
        ),
        COMMENT_SCHEMA,
    )


def state(spark, root, client=None):
    table = tables.current_table(spark, root, COMMENT_SCHEMA, COMMENT_KEY, client)
    assert table.schema.simpleString() == COMMENT_SCHEMA.simpleString()
    return {(row.comment_id, row.client, row.like_count) for row in table.collect()}


def test_versions(spark, tmp_path):
    root = str(tmp_path / "comments")
    assert state(spark, root) == set()

    def add(tag, *rows):
        tables.append_rows(spark, comments(spark, *rows), root, COMMENT_SCHEMA, tag)

    add("one", ("a", "x", 1, 1), ("b", "x", 1, 1))
    add("two", ("a", "x", 2, 2), ("a", "y", 9, 1))
    assert state(spark, root) == {("a", "x", 2), ("b", "x", 1), ("a", "y", 9)}
    assert tables.compact(spark, root, COMMENT_SCHEMA, COMMENT_KEY) == 3
    assert state(spark, root) == {("a", "x", 2), ("b", "x", 1), ("a", "y", 9)}

    add("three", ("b", "x", 7, 1), ("a", "x", 0, 1))  # equal time replaces, older does not
    add("three", ("b", "x", 100, 9))  # a tag counts once
    wanted = {("a", "x", 2), ("b", "x", 7), ("a", "y", 9)}
    assert state(spark, root) == wanted
    assert state(spark, root, "x") == wanted - {("a", "y", 9)}
    assert tables.compact(spark, root, COMMENT_SCHEMA, COMMENT_KEY) == 3
    assert tables.drop_superseded(spark, root, keep=1) == 4
    assert state(spark, root) == wanted


def test_any_tag_is_only_a_tag(spark, tmp_path):
    root = str(tmp_path / "comments")
    for tag, row in (("one", ("a", "x", 1, 1)), ("v", ("b", "x", 2, 1)), ("d", ("c", "x", 3, 1))):
        tables.append_rows(spark, comments(spark, row), root, COMMENT_SCHEMA, tag)
    assert state(spark, root) == {("a", "x", 1), ("b", "x", 2), ("c", "x", 3)}
    for tag in ("", "a/b", "a*", "{a}"):
        with pytest.raises(ValueError, match="tag"):
            tables.append_rows(spark, comments(spark, ("a", "x", 1, 1)), root, COMMENT_SCHEMA, tag)


def test_replay_after_clean_up(spark, tmp_path):
    root = str(tmp_path / "comments")

    def add(tag, like_count):
        rows = comments(spark, ("a", "x", like_count, 1)).withColumn("collected_at", F.lit(None).cast("timestamp"))
        return tables.append_rows(spark, rows, root, COMMENT_SCHEMA, tag).count()

    add("old", 1)
    add("new", 2)
    tables.compact(spark, root, COMMENT_SCHEMA, COMMENT_KEY)
    assert tables.drop_superseded(spark, root, keep=1) == 2
    assert add("old", 1) == 0
    assert state(spark, root) == {("a", "x", 2)}


def test_unfinished_versions_do_not_count(spark, tmp_path):
    root = str(tmp_path / "comments")
    assert tables.snapshot_sink(spark, comments(spark, ("a", "x", 1, 1)), root, COMMENT_SCHEMA) == 1
    assert tables.snapshot_sink(spark, comments(spark, ("a", "x", 2, 2)), root, COMMENT_SCHEMA) == 1
    files.remove(spark, f"{root}/v=00000001/_SUCCESS")
    assert state(spark, root) == {("a", "x", 1)}
    tables.append_rows(spark, comments(spark, ("b", "x", 3, 1)), root, COMMENT_SCHEMA, "t")
    assert state(spark, root) == {("a", "x", 1), ("b", "x", 3)}


def test_empty_snapshot(spark, tmp_path):
    root = str(tmp_path / "comments")
    assert tables.snapshot_sink(spark, comments(spark), root, COMMENT_SCHEMA) == 0
    assert state(spark, root) == set()


def test_client_read_is_pruned(spark, tmp_path):
    root = str(tmp_path / "comments")
    rows = [(str(n), f"u{n % 50}", n, 1) for n in range(500)]
    tables.snapshot_sink(spark, comments(spark, *rows), root, COMMENT_SCHEMA)
    tables.append_rows(spark, comments(spark, ("0", "u0", 5, 2)), root, COMMENT_SCHEMA, "t")
    table = tables.current_table(spark, root, COMMENT_SCHEMA, COMMENT_KEY, "u0")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "client_bucket" in plan and "PushedFilters: [" in plan
    assert "Nested" not in plan
    assert table.count() == 10


def test_contract_scan(spark, tmp_path):
    missing = tables.contract_scan(spark, str(tmp_path / "none.parquet"), VIDEO_SCHEMA)
    assert missing.count() == 0 and missing.schema == VIDEO_SCHEMA
    (tmp_path / "zero.parquet").touch()
    assert tables.contract_scan(spark, str(tmp_path / "zero.parquet"), VIDEO_SCHEMA).count() == 0

    frame = pd.DataFrame(
        {
            "like_count": [1, None],
            "video_id": ["7", "8"],
            "client": ["007", "x"],
            "extra": [1, 2],
            "transcript": [None, None],
            "hashtags": [[], []],
            "collected_at": pd.to_datetime(["2024-01-01T00:00:00Z"] * 2),
        }
    )
    frame.to_parquet(tmp_path / "drift.parquet", index=False)
    found = tables.contract_scan(spark, str(tmp_path / "drift.parquet"), VIDEO_SCHEMA)
    assert found.schema.simpleString() == VIDEO_SCHEMA.simpleString()
    rows = {row.video_id: row for row in found.collect()}
    assert (rows["7"].like_count, rows["8"].like_count) == (1, None)
    assert rows["7"].hashtags == [] and rows["7"].transcript is None and rows["7"].client == "007"
    assert found.select(F.unix_seconds("collected_at")).first()[0] == 1704067200

    by_client = str(tmp_path / "by_client")
    comments(spark, ("a", "007", 1, 1), ("b", "12", 1, 1)).write.partitionBy("client").parquet(by_client)
    scanned = tables.contract_scan(spark, by_client, COMMENT_SCHEMA)
    assert {row.client for row in scanned.collect()} == {"007", "12"}


def test_table_views(spark, tmp_path):
    comments(spark, ("a", "x", 1, 1), ("b", "y", 1, 1)).write.parquet(str(tmp_path / "c" / "one"))
    tables.table_views(spark, str(tmp_path / "v" / "*.parquet"), str(tmp_path / "c" / "*"), "x")
    assert spark.sql("SELECT count(*) FROM video").first()[0] == 0
    assert [row.comment_id for row in spark.sql("SELECT * FROM comments").collect()] == ["a"]


def test_registry_with_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "clients.csv").write_bytes(
        b'\xef\xbb\xbfclient,tiktok,instagram\r\n'
        b'"Two\nlines",https://x/@two,"a\r\n\r\nb, ""c"""\r\n'
        b'plain,https://x/@plain,\r\n'
        b'"""","https://x/@quote\n","\n"\r\n'
    )
    rows = registry_scan(spark, str(tmp_path / "clients.csv")).orderBy("row_ord").collect()
    assert [(row.client, row.handle, row.instagram) for row in rows] == [
        ("Two\nlines", "two", 'a\n\nb, "c"'), ("plain", "plain", None), ('"', "quote\n", "\n"),
    ]


def test_registry(spark, tmp_path):
    (tmp_path / "clients.csv").write_text(
        'instagram,client,tiktok\n'
        'https://i/1,"Ann, ""A""",https://x/@ann/\n'
        ',ann,https://x/@other\n'
        ',none,\n'
        ',nowhere,https://x/\n'
        ',other,https://x/@late\n'
        ',bare,x/@\n'
    )
    registry = registry_scan(spark, str(tmp_path / "clients.csv"))
    assert [row.handle for row in registry.orderBy("row_ord").collect()] == [
        "ann", "other", None, None, "late", "",
    ]
    names = ['Ann, "A"', "ann", "other", "none", "nowhere", "late", "bare", "", "?"]
    asked = spark.createDataFrame([(name,) for name in names], "identifier string")
    found = {row.identifier: row.handle for row in resolve_handles(asked, registry).collect()}
    assert found == {
        'Ann, "A"': "ann", "ann": "ann", "other": "other", "none": None, "nowhere": None,
        "late": "late", "bare": None, "": None, "?": None,
    }
    resolved = resolve_handles(asked.where("identifier = '?'"), registry)
    with pytest.raises(Exception, match="not in the registry"):
        require_resolved(resolved).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        registry_scan(spark, str(tmp_path / "missing.csv")).count()


def test_first_registry_row_counts(spark, tmp_path):
    lines = ["client,tiktok,instagram"] + [f"same,https://x/@h{n}," for n in range(5000)]
    (tmp_path / "clients.csv").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        registry = registry_scan(spark, str(tmp_path / "clients.csv"))
        assert registry.rdd.getNumPartitions() > 1
        asked = spark.createDataFrame([("same",), ("h4999",)], "identifier string")
        found = {row.identifier: row.handle for row in resolve_handles(asked, registry).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {"same": "h0", "h4999": "h4999"}


def test_scratch_follows_the_session(spark):
    from clipledger.session import scratch_dir, shared_dir

    base = shared_dir(spark)
    found = scratch_dir(spark, "x")
    assert found.startswith(base) if base else found.startswith("/tmp/run-")


def test_wall_clock_times_count_as_utc(spark):
    wide = spark.sql("SELECT 'a' AS comment_id, TIMESTAMP_NTZ'2024-07-01 12:00:00' AS created_at")
    row = tables.to_contract(wide, T.StructType(COMMENT_SCHEMA.fields)).select(
        F.unix_seconds("created_at").alias("s")
    ).first()
    assert row.s == (datetime(2024, 7, 1, 12) - datetime(1970, 1, 1)).total_seconds()
