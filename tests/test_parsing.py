from clipledger.operators.parsing import parse_comments, parse_videos
from clipledger.sources.contracts import COMMENT_SCHEMA, VIDEO_SCHEMA


def test_videos_without_usable_id_drop(documents):
    items = documents(
        '{"id":0}', '{"id":"","aweme_id":"5"}', "[1]", '"text"', "null", "{}", '{"id":"0"}',
        '{"id":null,"aweme_id":7}', '{"id":false}',
    )
    rows = parse_videos(items, keep=("n",)).collect()
    assert {(row.n, row.video_id) for row in rows} == {(6, "0"), (7, "7")}
    assert parse_videos(items).schema.simpleString() == VIDEO_SCHEMA.simpleString()


def test_video_falls_through_empty_objects_only(documents):
    items = documents(
        '{"id":1,"stats":{},"statsV2":{"diggCount":3}}',
        '{"id":2,"stats":{"diggCount":null},"statsV2":{"diggCount":3}}',
        '{"id":3,"stats":"text","statistics":{"digg_count":3}}',
        '{"id":4,"stats":{"diggCount":"abc","digg_count":2}}',
        '{"id":5,"music":{},"added_sound_music_info":{"title":"t"}}',
        '{"id":6,"music":{"x":1},"added_sound_music_info":{"title":"t"}}',
        '{"id":7,"desc":"","content_desc":"c"}',
        '{"id":8,"desc":null,"content_desc":"c"}',
    )
    rows = {row.video_id: row for row in parse_videos(items).collect()}
    assert [rows[str(n)].like_count for n in (1, 2, 3, 4)] == [3, None, None, None]
    assert [rows[str(n)].music for n in (5, 6)] == ["t", None]
    assert [rows[str(n)].caption for n in (7, 8)] == ["", "c"]
    assert all(row.hashtags == [] and row.transcript is None for row in rows.values())


def test_comments(documents):
    items = documents(
        '{"cid":"a","id":"b","text":"t","digg_count":1,"diggCount":2,"reply_total":3}',
        '{"cid":"","id":"b"}', '{"id":9,"diggCount":2}', "{}",
    )
    rows = parse_comments(items, keep=("n",)).orderBy("n").collect()
    assert [(row.comment_id, row.like_count, row.reply_count) for row in rows] == [
        ("a", 1, 3), ("9", 2, None),
    ]
    assert {row.video_id for row in rows} == {"v1"}
    assert parse_comments(items).schema.simpleString() == COMMENT_SCHEMA.simpleString()


def test_whole_long_texts_survive(documents):
    text = "wörd " * 200_000
    row = parse_comments(documents(f'{{"cid":"a","text":"{text}"}}')).first()
    assert row.text == text
