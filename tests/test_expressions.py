"""Hand-written edge cases per expression."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clipledger.functions import scalars as S
from clipledger.functions import variants as V


@pytest.fixture
def evaluate(spark):
    """Results of an expression over JSON documents (or plain text), in order."""

    def run(expression, *texts, is_json=True):
        rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
        value = F.parse_json("text") if is_json else F.col("text")
        staged = rows.select("n", value.alias("value")).select(
            "n", expression(F.col("value")).alias("x")
        )
        return [row.x for row in staged.orderBy("n").collect()]

    return run


def test_first_present(evaluate):
    assert evaluate(
        lambda v: F.to_json(V.first_present(v, "a", "b")),
        '{"a":null,"b":2}', '{"a":"","b":2}', '{"a":0,"b":2}', '{"a":false,"b":2}',
        '{"a":{},"b":2}', "{}", "[1]", '"a"',
    ) == ["2", '""', "0", "false", "{}", None, None, None]


def test_no_fall_through_after_selection(evaluate):
    assert evaluate(
        lambda v: V.to_int(V.first_present(v, "a", "b")), '{"a":"abc","b":2}', '{"a":null,"b":2}'
    ) == [None, 2]


def test_last_of_repeated_keys_counts(evaluate):
    assert evaluate(lambda v: V.to_int(V.at(v, "a")), '{"a":1,"a":2}') == [2]


def test_truthy(evaluate):
    falsy = ["null", "false", "0", "0.0", "-0.0", "0e5", '""', "[]", "{}"]
    true = ["true", "1", "-1", "0.5", '"0"', '"false"', '"null"', '" "', "[0]", '{"a":null}']
    assert evaluate(V.truthy, *falsy) == [False] * len(falsy)
    assert evaluate(V.truthy, *true) == [True] * len(true)
    assert evaluate(lambda v: V.truthy(V.at(v, "a")), "{}") == [False]


def test_either_keeps_a_falsy_last_value(evaluate):
    assert evaluate(
        lambda v: F.to_json(V.either(V.at(v, "a"), V.at(v, "b"))),
        '{"a":"x","b":"y"}', '{"a":"","b":"y"}', '{"a":0,"b":""}', '{"a":0,"b":null}', '{"a":0}',
    ) == ['"x"', '"y"', '""', None, None]


@pytest.mark.parametrize(
    "text, value",
    [
        ("7", 7), ('"7"', 7), ('" 7 "', 7), ('"+7"', 7), ('"-7"', -7), ('"\\t7\\n"', 7),
        ("12.9", 12), ("-12.9", -12), ("true", 1), ("false", 0), ("1e3", 1000),
        ('"12.5"', None), ('"1e3"', None), ('"abc"', None), ('""', None), ('"+"', None),
        ('"7 7"', None), ("null", None), ("{}", None), ("[7]", None), ('"true"', None),
        ("9223372036854775807", 9223372036854775807),
        ('"9223372036854775807"', 9223372036854775807),
        ("9223372036854775808", None), ('"9223372036854775808"', None), ('"007"', 7), ('"--7"', None),
        ('"7\\"7"', None), ('"\\\\7"', None),
    ],
)
def test_to_int(evaluate, text, value):
    assert evaluate(V.to_int, text) == [value]


def test_epoch_to_utc(evaluate):
    def micros(v):
        return F.unix_micros(S.epoch_to_utc(V.to_int(v)))

    million = 1_000_000
    assert evaluate(
        micros, "0", '"86400"', "253402300799", "253402300800", "1700000000000",
        "-62135596800", "-62135596801", "9223372036854775807", '"x"',
    ) == [0, 86400 * million, 253402300799 * million, None, None,
          -62135596800 * million, None, None, None]
    assert evaluate(
        lambda v: S.as_utc_ntz(S.epoch_to_utc(V.to_int(v))), "253402300799"
    ) == [datetime(9999, 12, 31, 23, 59, 59)]


def test_author_hash(evaluate):
    digest = "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"
    assert evaluate(S.author_hash, "x", "", None, "žluť", is_json=False) == [
        digest, None, None, hashlib.sha256("žluť".encode()).hexdigest(),
    ]
    salted = hashlib.sha256(b"sx").hexdigest()
    assert evaluate(lambda v: S.author_hash(v, "s"), "x", "", is_json=False) == [salted, None]


def test_comment_author(evaluate):
    assert evaluate(
        lambda v: S.comment_author(V.read(v, S.AUTHOR_SHAPE)),
        '{"user":{"unique_id":"a","uniqueId":"b"}}', '{"user":{"uniqueId":"b"}}',
        '{"user":{"unique_id":""},"uid":"c"}', '{"user":{"unique_id":"","uniqueId":"b"}}',
        '{"user":null,"uid":7}', '{"user":[],"uid":0}', '{"user":"a"}', "{}",
    ) == ["a", "b", "c", None, "7", None, None, None]


def test_overlay_text(evaluate):
    assert evaluate(
        lambda v: S.overlay_text(V.read(v, S.OVERLAY_SHAPE)),
        '{"stickersOnItem":[{"stickerText":[" hi ","",null,"\\tyo\\u00a0"]}],"contents":[{"desc":"d"}]}',
        '{"stickersOnItem":[{"stickerText":["  ","\\u3000"]}],"contents":[{"desc":" "},{}]}',
        '{"stickersOnItem":"text","contents":[null,{"desc":"d"}]}',
        '{"stickersOnItem":[null,"x",{"stickerText":"y"},{"stickerText":["z",5]}]}',
        '{"contents":{"desc":"d"}}', "{}", '{"contents":[{"desc":"a\\nb"}]}',
        '{"stickersOnItem":[]}',
    ) == ["hi\nyo\nd", None, "d", "z\n5", None, None, "a\nb", None]


def test_hashtags(evaluate):
    assert evaluate(
        lambda v: S.hashtags(V.read(v, S.HASHTAG_SHAPE)),
        '{"text_extra":[{"hashtag_name":"b"},{"hashtag_name":"a"}],"textExtra":[{"hashtagName":"a"}]}',
        '{"textExtra":[{"hashtagName":"","hashtag_name":"z"},{"hashtagName":null,"hashtag_name":"y"}]}',
        '{"textExtra":null,"text_extra":"x","content_desc_extra":[null,{},{"hashtag_name":7}]}',
        "{}", '{"textExtra":[{"hashtagName":0},{"hashtagName":"0"}]}',
    ) == [["a", "b"], ["y"], ["7"], [], ["0"]]


def test_canonical_url(evaluate):
    def url(v):
        return S.canonical_url(F.lit("9"), V.read(v, S.OWNER_SHAPE), F.lit("me"))

    prefix = "https://www.tiktok.com/@"
    assert evaluate(
        url, '{"author":{"uniqueId":"a"}}', '{"author":{"uniqueId":null,"unique_id":"b"}}',
        '{"author":{"uniqueId":"","unique_id":"b"}}', '{"author":{}}', '{"author":"x"}', "{}",
    ) == [f"{prefix}{name}/video/9" for name in ("a", "b", "me", "me", "me", "me")]


def test_parent_comment_id(evaluate):
    assert evaluate(
        lambda v: S.parent_comment_id(V.read(v, S.PARENT_SHAPE)),
        '{"reply_id":"0"}', '{"reply_id":0}', "{}", '{"reply_id":"0","reply_to_reply_id":"5"}',
        '{"reply_id":null,"replyId":"5"}', '{"reply_id":""}', '{"reply_comment_id":12}',
        '{"reply_id":false}',
    ) == [None, None, None, None, "5", "", "12", None]


def test_links(evaluate):
    assert evaluate(
        S.extract_video_id, "77", " 77\t", "https://x/@a/video/88?x=1", "bad", "", None,
        "/video/x/video/9", is_json=False,
    ) == ["77", "77", "88", None, None, None, "9"]
    assert evaluate(
        S.handle_from_url, "https://x/@ab//", "https://x/", "x/@", "a@b@c", "", None, is_json=False
    ) == ["ab", None, "", "c", None, None]
    assert evaluate(
        lambda v: S.video_url(v, F.lit("me")), "http://any", "5", "/video/6/", "bad", is_json=False
    ) == ["http://any", "https://www.tiktok.com/@me/video/5", "https://www.tiktok.com/@me/video/6", None]
    assert evaluate(S.video_url, "5", is_json=False) == ["https://www.tiktok.com/@tiktok/video/5"]


def test_error_message(evaluate):
    assert evaluate(
        S.error_message, '{"message":"m","error":"e"}', '{"message":"","error":"e"}',
        '{"code":5}', "{}", "[1]", '"quoted"', " plain text ", "x" * 300, "", None, is_json=False,
    ) == ["m", "e", '{"code":5}', "{}", "[1]", "quoted", "plain text", "x" * 300, "", ""]
    short = lambda v: S.error_message(v, length=200)
    assert evaluate(short, "x" * 300, is_json=False) == ["x" * 200]


def test_type_name(evaluate):
    texts = ["null", "true", "5", "5.5", "1e3", "2.0", '"a"', "{}", "[]", "123456789012345678901"]
    assert evaluate(V.type_name, *texts) == [
        "null", "bool", "int", "float", "float", "float", "str", "dict", "list", "int",
    ]
    assert evaluate(
        lambda v: V.type_name(v, preview=True), '""', '"a\\nb"', f'"{"y" * 80}"'
    ) == ["str (empty)", "str ('a b')", f"str ('{'y' * 80}')"]
    assert evaluate(lambda v: V.type_name(v, True, 60), f'"{"y" * 80}"') == [f"str ('{'y' * 60}')"]
    texts = ["it's", 'say "x"', "it's \"x\"", "a\tb", "a\\b"]
    assert evaluate(lambda v: V.type_name(v, preview=True), *map(json.dumps, texts)) == [f"str ({t!r})" for t in texts]


def test_utc_round_trip(spark):
    text = "TIMESTAMP_NTZ'2020-03-08 02:30:00.123456'"  # does not exist in the session's zone
    row = spark.range(1).select(S.as_utc_ntz(S.from_utc_ntz(F.expr(text))).alias("x")).first()
    assert row.x == datetime(2020, 3, 8, 2, 30, 0, 123456)
