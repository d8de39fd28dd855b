"""Column contracts of the tables and of landed responses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _COUNT, _TIME = T.StringType(), T.LongType(), T.TimestampType()

# Column names, types and order of the two tables.
VIDEO_SCHEMA = _schema(
    ("video_id", _TEXT),
    ("client", _TEXT),
    ("url", _TEXT),
    ("created_at", _TIME),
    ("caption", _TEXT),
    ("overlay_text", _TEXT),
    ("transcript", _TEXT),
    ("hashtags", T.ArrayType(_TEXT)),
    ("music", _TEXT),
    ("duration_s", _COUNT),
    ("like_count", _COUNT),
    ("comment_count", _COUNT),
    ("share_count", _COUNT),
    ("play_count", _COUNT),
    ("collected_at", _TIME),
)
VIDEO_KEY = "video_id"

COMMENT_SCHEMA = _schema(
    ("comment_id", _TEXT),
    ("video_id", _TEXT),
    ("client", _TEXT),
    ("text", _TEXT),
    ("like_count", _COUNT),
    ("reply_count", _COUNT),
    ("parent_comment_id", _TEXT),
    ("author_hash", _TEXT),
    ("created_at", _TIME),
    ("collected_at", _TIME),
)
COMMENT_KEY = "comment_id"

# Columns of the client registry.
REGISTRY_COLUMNS = ("client", "tiktok", "instagram")

# One landed response. ``run_id`` names the crawl, so that two crawls of one video stay apart.
ENVELOPE_SCHEMA = _schema(
    ("run_id", _TEXT),
    ("endpoint", _TEXT),
    ("client", _TEXT),
    ("video_id", _TEXT),
    ("parent_comment_id", _TEXT),
    ("page_seq", T.IntegerType()),
    ("request_cursor", _COUNT),
    ("http_status", T.IntegerType()),
    ("body", _TEXT),
    ("fetched_at", _TIME),
)

# Where a landed line that is no JSON object can be found again; its text is not kept.
BROKEN_SCHEMA = _schema(
    ("file", _TEXT),
    ("block", _COUNT),
    ("length", _COUNT),
    ("sha256", _TEXT),
    ("reason", _TEXT),
)

# What identifies one paginated request.
REQUEST = ("run_id", "endpoint", "client", "video_id", "parent_comment_id")


@dataclass(frozen=True)
class Family:
    """Where one kind of response keeps its items, its next cursor and its item ids."""

    endpoint: str
    item_keys: tuple[str, ...]
    cursor_key: str
    id_keys: tuple[str, str]
    limit: int


# Key names and default bounds of the paginated responses.
PROFILE_VIDEOS = Family("profile_videos", ("aweme_list",), "max_cursor", ("aweme_id", "id"), 30)
COMMENTS = Family("comments", ("comments",), "cursor", ("cid", "id"), 200)
REPLIES = Family("replies", ("comments", "replies"), "cursor", ("cid", "id"), 1000)

FAMILIES = (PROFILE_VIDEOS, COMMENTS, REPLIES)

# The single-video response is one object, not a page.
VIDEO_ENDPOINT = "video"
VIDEO_ITEM_KEY = "aweme_detail"
