"""Ingestion end to end: runs, replays, late pages, and the stream against one batch."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from clipledger.plans import collect as C
from clipledger.plans import ingest
from clipledger.sources.contracts import ENVELOPE_SCHEMA
from clipledger.sources.landing import broken_lines, from_envelopes, payload_scan
from clipledger.streaming.incremental import ingest_incremental


def landed_rows(run="r1", likes=1, day=1, videos=6, pages=3):
    """One creator's crawl: a profile page, comment pages and a reply thread per video."""
    at = f"1970-01-{day + 1:02d}T00:00:00Z"

    def row(endpoint, video, parent, page, body):
        return {
            "run_id": run, "endpoint": endpoint, "client": "c", "video_id": video,
            "parent_comment_id": parent, "page_seq": page, "request_cursor": page * 2,
            "http_status": 200, "body": json.dumps(body), "fetched_at": at,
        }

    listed = [{"aweme_id": str(n), "statistics": {"digg_count": likes}} for n in range(videos)]
    rows = [row("profile_videos", None, None, 0, {"aweme_list": listed, "has_more": 0})]
    for n in range(videos):
        for page in range(pages):
            items = [
                {"cid": f"{n}-{page}-{i}", "digg_count": likes, "user": {"unique_id": "who"},
                 "reply_comment_total": 1 if page == i == 0 else 0}
                for i in range(2)
            ]
            body = {"comments": items, "has_more": int(page < pages - 1), "cursor": 2 * page + 2}
            rows.append(row("comments", str(n), None, page, body))
        reply = {"comments": [{"cid": f"{n}-r", "reply_id": f"{n}-0-0"}], "has_more": 0}
        rows.append(row("replies", str(n), f"{n}-0-0", 0, reply))
    return rows


def frame(spark, rows):
    lines = spark.createDataFrame([(json.dumps(row),) for row in rows], "value string")
    names = [f.name for f in ENVELOPE_SCHEMA]
    kinds = ",".join(f"{f.name} {f.dataType.simpleString()}" for f in ENVELOPE_SCHEMA)
    return from_envelopes(lines.select(F.from_json("value", kinds).alias("r")).select(
        *[F.col(f"r.{name}") for name in names]
    ))


def contents(spark, root):
    def rows(table, *names):
        return sorted(tuple(row) for row in table.select(*names).collect())

    return (
        rows(ingest.current_videos(spark, root), "video_id", "like_count", F.unix_seconds("collected_at")),
        rows(ingest.current_comments(spark, root), "comment_id", "video_id", "like_count",
             F.coalesce("parent_comment_id", F.lit("")), F.unix_seconds("collected_at")),
    )


def untimed(rows):
    return [tuple(-1 if value is None else value for value in row) for row in rows]


BOUNDS = {"max_videos": 4, "comment_count": 5, "include_replies": True}


def batch(spark, root, *runs):
    for rows in runs:
        ingest.ingest_sweep(spark, frame(spark, rows), root, **BOUNDS)
    return contents(spark, root)


def safe(found):
    return tuple(untimed(part) for part in found)


def test_sweep(spark, tmp_path):
    root = str(tmp_path / "data")
    summary = ingest.ingest_sweep(spark, frame(spark, landed_rows()), root, **BOUNDS)
    rows = {row.video_id: row for row in summary.collect()}
    assert sorted(rows) == ["0", "1", "2", "3"]
    assert {row.comments_collected for row in rows.values()} == {6}
    assert {row.video_rows_total for row in rows.values()} == {4}
    assert {row.comment_rows_total for row in rows.values()} == {24}

    # A second crawl with newer counts updates in place; an older one changes nothing.
    ingest.ingest_sweep(spark, frame(spark, landed_rows("r2", likes=9, day=5)), root, **BOUNDS)
    ingest.compact_tables(spark, root)
    before = safe(contents(spark, root))
    ingest.ingest_sweep(spark, frame(spark, landed_rows("r0", likes=3, day=0)), root, **BOUNDS)
    after = safe(contents(spark, root))
    assert before == after
    assert {likes for _, likes, _ in after[0]} == {9} and len(after[1]) == 24


def test_named_video(spark, tmp_path):
    root = str(tmp_path / "data")
    rows = landed_rows()
    detail = dict(rows[0], endpoint="video", video_id="2",
                  body=json.dumps({"aweme_detail": {"id": "2", "desc": "two"}}))
    landed = frame(spark, [*rows[1:], detail])
    link = "https://www.tiktok.com/@c/video/2"
    summary = ingest.ingest_video(spark, landed, root, video=link, include_replies=True).collect()
    assert [(row.video_id, row.caption, row.comments_collected) for row in summary] == [("2", "two", 7)]
    with pytest.raises(RuntimeError, match="no usable response"):
        ingest.ingest_video(spark, landed, root, video="3")
    assert ingest.current_videos(spark, root).count() == 1


def test_failed_responses(spark):
    rows = landed_rows(videos=2)
    rows[1] = dict(rows[1], http_status=429, body="slow down")
    rows[5] = dict(rows[5], body="{bad")
    with ingest.staged_pages(spark, frame(spark, rows)) as staged:
        failed = {(row.route, row.message) for row in C.failed_responses(staged).collect()}
        kept = C.video_comments(staged, C.profile_videos(staged)).count()
    assert failed == {("transient", "slow down"), ("terminal", "bad JSON")}
    # Both videos lost their first page, so what follows it does not count either.
    assert kept == 0


def test_stream_equals_batch(spark, tmp_path):
    """Pages of two crawls land in any order over two calls and three micro-batches."""
    first, second = landed_rows(), landed_rows("r2", likes=7, day=3)
    wanted = safe(batch(spark, str(tmp_path / "batch"), first, second))
    rows = [*first, *second]
    random.Random(1).shuffle(rows)
    landing, root, state = (tmp_path / name for name in ("landing", "tables", "state"))
    landing.mkdir()
    for call, parts in enumerate(((0, 1), (2,))):
        for part in parts:
            share = rows[part::3]
            (landing / f"{call}-{part}.json").write_text("\n".join(map(json.dumps, share)))
        ingest_incremental(
            spark, str(landing), str(root), str(state), max_files_per_batch=1, **BOUNDS
        )
    assert safe(contents(spark, str(root))) == wanted
    ingest_incremental(spark, str(landing), str(root), str(state), **BOUNDS)
    assert safe(contents(spark, str(root))) == wanted


def test_many_batches_in_any_order(spark, tmp_path):
    """A page or two at a time, videos before their profile page and replies before their comments; each page is opened once."""
    rows = landed_rows(videos=3)
    wanted = safe(batch(spark, str(tmp_path / "batch"), rows))
    random.Random(5).shuffle(rows)
    landing, root, state = (tmp_path / name for name in ("landing", "tables", "state"))
    landing.mkdir()
    for number in range(0, len(rows), 2):
        (landing / f"{number:02d}.json").write_text("\n".join(map(json.dumps, rows[number : number + 2])))
    ingest_incremental(spark, str(landing), str(root), str(state), max_files_per_batch=1, **BOUNDS)
    assert safe(contents(spark, str(root))) == wanted
    # One more batch, of another crawl: what no longer waits is gone.
    (landing / "zz.json").write_text("\n".join(map(json.dumps, landed_rows("r9", videos=1))))
    ingest_incremental(spark, str(landing), str(root), str(state), **BOUNDS)
    assert len(list((state / "pages").glob("batch=*"))) < 4


def test_replayed_batch_changes_nothing(spark, tmp_path):
    landing, root, state = (tmp_path / name for name in ("landing", "tables", "state"))
    landing.mkdir()
    (landing / "a.json").write_text("\n".join(map(json.dumps, landed_rows())))
    ingest_incremental(spark, str(landing), str(root), str(state), **BOUNDS)
    once = safe(contents(spark, str(root)))
    versions = sorted(path.name for path in (root / "comments").iterdir())
    # Forget that the batch was finished, as after a driver lost before noting it.
    for note in (state / "checkpoint" / "commits").iterdir():
        note.unlink()
    ingest_incremental(spark, str(landing), str(root), str(state), **BOUNDS)
    assert safe(contents(spark, str(root))) == once
    assert sorted(path.name for path in (root / "comments").iterdir()) == versions


def test_broken_lines(spark, tmp_path):
    rows = landed_rows(videos=1)
    texts = [json.dumps(row) for row in rows]
    cut, deep = texts[1][:60], texts[2][:-1]
    (tmp_path / "a.json").write_text("\n".join([texts[0], "", cut, "  ", *texts[3:]]))
    (tmp_path / "b.json").write_text("\n".join([deep, "[1]", '"naïve"']))
    scanned = payload_scan(spark, str(tmp_path))
    found = sorted((r.file.rsplit("/", 1)[1], r.block, r.length, r.sha256, r.reason) for r in broken_lines(scanned).collect())

    def wanted(name, text, reason):
        data = text.encode()
        return name, 0, len(data), hashlib.sha256(data).hexdigest(), reason

    assert found == sorted([
        wanted("a.json", cut, "not JSON"), wanted("b.json", deep, "not JSON"),
        wanted("b.json", "[1]", "not an object"), wanted("b.json", '"naïve"', "not an object"),
    ])
    with ingest.staged_pages(spark, scanned) as staged:
        failed = C.failed_responses(staged).where("broken is not null").collect()
    assert {(r.route, r.message) for r in failed} == {
        ("terminal", "broken line: not JSON"), ("terminal", "broken line: not an object"),
    }
    assert sorted(r.broken.length for r in failed) == sorted(one[2] for one in found)


def test_payload_scan_shapes(spark, tmp_path):
    row = landed_rows(videos=1)[1]
    nested = dict(row, body=json.loads(row["body"]), page_seq=1)
    path = tmp_path / "pages.json"
    path.write_text("\n".join([json.dumps(row), json.dumps(nested), "not json", "{}"]))
    found = payload_scan(spark, str(path)).collect()
    shapes = sorted((row.page_seq, row.body is None, row.payload is None) for row in found if row.endpoint)
    assert shapes == [(0, False, True), (1, True, False)]
    assert len(found) == 4
