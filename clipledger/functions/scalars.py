"""Typed column expressions for ids, links, clocks, anonymised authors and item text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipledger.functions import variants as V

# The canonical link of a video.
SITE = "https://www.tiktok.com/@"
DEFAULT_OWNER = "tiktok"

# The epoch seconds of the first and last second of years 1 to 9999.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799

# JSON renderings that mean "answers no other comment".
NO_PARENT_JSON = ('"0"', "0", "0.0", "-0.0", "false")

_SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Trim every kind of white space, no-break and ideographic spaces included."""
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def epoch_to_utc(seconds: Column) -> Column:
    """Unix seconds to an instant; null outside years 1..9999 (so milliseconds give null)."""
    return F.when(
        seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds)
    )


def collected_at(fetched_at: Column | None = None) -> Column:
    """Snapshot time: when the page was fetched, else now."""
    now = F.current_timestamp()
    return now if fetched_at is None else F.coalesce(fetched_at, now)


def author_hash(handle: Column, salt: str = "") -> Column:
    """SHA-256 hex of a handle; null for a missing or empty one. Unsalted unless asked."""
    known = F.when(handle != "", handle)
    return F.sha2(F.concat(F.lit(salt), known) if salt else known, 256)


# Where an item keeps the fields below. Several keys are tried in order.
AUTHOR_SHAPE = "user:struct<unique_id:variant,uniqueId:variant,uid:variant>,uid:variant"
OVERLAY_SHAPE = (
    "stickersOnItem:array<struct<stickerText:array<variant>>>,contents:array<struct<desc:variant>>"
)
HASHTAG_KEYS = ("textExtra", "text_extra", "content_desc_extra")
HASHTAG_SHAPE = ",".join(
    f"{key}:array<struct<hashtagName:variant,hashtag_name:variant>>" for key in HASHTAG_KEYS
)
OWNER_SHAPE = "author:struct<uniqueId:variant,unique_id:variant>"
PARENT_KEYS = ("reply_id", "replyId", "reply_to_reply_id", "reply_comment_id")
PARENT_SHAPE = ",".join(f"{key}:variant" for key in PARENT_KEYS)


def comment_author(item: Column) -> Column:
    """Handle of a comment's author as text, else the item's own uid; null when neither is truthy.

    This and the next functions take an item read with the matching ``_SHAPE``.
    """
    user = item["user"]
    handle = V.first_of(user["unique_id"], user["uniqueId"], user["uid"])
    return V.to_text(V.first_truthy(handle, item["uid"]))


def _or_empty(values: Column, kind: str) -> Column:
    return F.coalesce(values, F.expr(f"cast(array() as array<{kind}>)"))


def overlay_text(item: Column) -> Column:
    """Sticker texts, then content descriptions, one per line; null when nothing is left."""
    stickers = F.transform(
        item["stickersOnItem"], lambda one: _or_empty(one["stickerText"], "variant")
    )
    captions = F.transform(item["contents"], lambda one: one["desc"])
    kept = F.filter(
        F.concat(_or_empty(F.flatten(stickers), "variant"), _or_empty(captions, "variant")),
        V.truthy,
    )
    lines = F.transform(kept, lambda one: strip(V.to_text(one)))
    return F.nullif(
        F.array_join(F.filter(lines, lambda line: line != ""), "\n"), F.lit("")
    )


def hashtags(item: Column) -> Column:
    """Hashtag names of all three lists in order, first mention kept; never null."""
    kind = "struct<hashtagName:variant,hashtag_name:variant>"
    extras = F.concat(*[_or_empty(item[key], kind) for key in HASHTAG_KEYS])
    names = F.transform(
        extras, lambda extra: V.first_of(extra["hashtagName"], extra["hashtag_name"])
    )
    return F.array_distinct(F.transform(F.filter(names, V.truthy), V.to_text))


def canonical_url(video_id: Column, item: Column, client: Column) -> Column:
    """Link of a video under its author's name, or the client's when the author has none."""
    name = V.first_of(item["author"]["uniqueId"], item["author"]["unique_id"])
    owner = F.coalesce(V.to_text(F.when(V.truthy(name), name)), client)
    return F.concat(F.lit(SITE), owner, F.lit("/video/"), video_id)


def parent_comment_id(item: Column) -> Column:
    """Id of the comment answered; null for top-level comments, which say 0 or nothing."""
    pid = V.first_of(*[item[key] for key in PARENT_KEYS])
    return F.when(~F.to_json(pid).isin(*NO_PARENT_JSON), V.to_text(pid))


def extract_video_id(link: Column) -> Column:
    """Bare numeric id, or the id in a video link; null when there is none."""
    text = strip(link)
    return F.when(text.rlike(r"(?U)^\d+$"), text).otherwise(
        F.nullif(F.regexp_extract(text, r"(?U)/video/(\d+)", 1), F.lit(""))
    )


def handle_from_url(url: Column) -> Column:
    """Text after the last @ of a profile link, trailing slashes aside; null without @."""
    path = F.rtrim(url, F.lit("/"))
    return F.when(F.contains(path, F.lit("@")), F.substring_index(path, "@", -1))


def video_url(link: Column, handle: Column | None = None) -> Column:
    """Links pass through; a bare id becomes a link under ``handle`` or the default owner."""
    text = strip(link)
    default = F.lit(DEFAULT_OWNER)
    owner = default if handle is None else F.coalesce(F.nullif(handle, F.lit("")), default)
    built = F.concat(F.lit(SITE), owner, F.lit("/video/"), extract_video_id(text))
    return F.when(text.startswith("http"), text).otherwise(built)


def error_message(body: Column, payload: Column | None = None, length: int | None = None) -> Column:
    """Readable text from an error response: all of it, or its first ``length`` characters.

    An object answers with its message, its error, or its own JSON text. ``payload`` is the
    parsed body, for callers that have it already.
    """
    parsed = F.try_parse_json(body) if payload is None else payload
    said = V.first_truthy(V.at(parsed, "message"), V.at(parsed, "error"))
    text = F.coalesce(V.to_text(said), V.to_text(parsed), strip(body), F.lit(""))
    return text if length is None else F.left(text, F.lit(length))


def has_value(column: Column) -> Column:
    """Presence flag for the optional text columns."""
    return column.isNotNull()


def as_utc_ntz(instant: Column) -> Column:
    """An instant as UTC wall-clock time, whatever the session zone."""
    return F.timestamp_add(
        "MICROSECOND",
        F.unix_micros(instant),
        F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
    )


def from_utc_ntz(wall_clock: Column) -> Column:
    """UTC wall-clock time as an instant, whatever the session zone.

    Put together from date and clock fields: differences of wall-clock times go through the
    session zone, where some of them do not exist.
    """
    days = F.datediff(wall_clock.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(wall_clock)) * 60 + F.minute(wall_clock)
    seconds = minutes * 60 + F.date_part(F.lit("SECONDS"), wall_clock)
    return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))
