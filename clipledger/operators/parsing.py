"""Raw items to typed rows. Each is one projection and one filter over a VARIANT column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipledger.functions import scalars as S
from clipledger.functions import variants as V


# Where raw items keep what becomes a column, the first present key counting.
VIDEO_SHAPE = (
    "id:variant,aweme_id:variant,createTime:variant,create_time:variant,"
    "desc:string,content_desc:string,"
    "stats:variant,statsV2:variant,statistics:variant,"
    "music:variant,added_sound_music_info:variant,video:struct<duration:variant>",
    S.OWNER_SHAPE,
    S.OVERLAY_SHAPE,
    S.HASHTAG_SHAPE,
)
STATS_SHAPE = (
    "diggCount:variant,digg_count:variant,commentCount:variant,comment_count:variant,"
    "shareCount:variant,share_count:variant,playCount:variant,play_count:variant"
)
COMMENT_SHAPE = (
    "cid:variant,id:variant,text:string,digg_count:variant,diggCount:variant,"
    "reply_comment_total:variant,replyCommentTotal:variant,reply_total:variant,"
    "create_time:variant,createTime:variant",
    S.PARENT_SHAPE,
    S.AUTHOR_SHAPE,
)


def _read_items(
    items: DataFrame, shape: Sequence[str], id_keys: Sequence[str], others: Sequence[str]
) -> DataFrame:
    """Items read into ``r`` with their id in ``raw_id``; those without a truthy id drop out.

    They drop out in an explode of at most one element. A filter would be pushed below the
    projection and read every item twice.
    """
    read = items.select(*others, V.read(F.col("item"), *shape).alias("r"))
    raw_id = V.first_of(*[F.col("r")[key] for key in id_keys])
    kept = F.explode(F.when(V.truthy(raw_id), F.array("r"))).alias("r")
    return read.select(*others, kept).withColumn("raw_id", raw_id)


def parse_videos(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Video rows from ``item``, ``client`` and ``fetched_at``; ``keep`` passes columns through.

    An item without a truthy id gives no row, and so does anything that is not an object.
    """
    r = F.col("r")
    staged = _read_items(
        items, VIDEO_SHAPE, ("id", "aweme_id"), ("client", "fetched_at", *keep)
    )
    stats = V.first_truthy(r["stats"], r["statsV2"], r["statistics"])
    music = V.first_truthy(r["music"], r["added_sound_music_info"])
    staged = staged.select(
        "*",
        V.to_text(F.col("raw_id")).alias("video_id"),
        V.read(stats, STATS_SHAPE).alias("stats"),
        V.read(music, "title:string")["title"].alias("music"),
    )

    def metric(web: str, native: str) -> Column:
        return V.to_int(V.first_of(F.col("stats")[web], F.col("stats")[native]))

    return staged.select(
        "video_id",
        "client",
        S.canonical_url(F.col("video_id"), r, F.col("client")).alias("url"),
        S.epoch_to_utc(V.to_int(V.first_of(r["createTime"], r["create_time"]))).alias("created_at"),
        F.coalesce(r["desc"], r["content_desc"]).alias("caption"),
        S.overlay_text(r).alias("overlay_text"),
        F.lit(None).cast("string").alias("transcript"),
        S.hashtags(r).alias("hashtags"),
        "music",
        V.to_int(r["video"]["duration"]).alias("duration_s"),
        metric("diggCount", "digg_count").alias("like_count"),
        metric("commentCount", "comment_count").alias("comment_count"),
        metric("shareCount", "share_count").alias("share_count"),
        metric("playCount", "play_count").alias("play_count"),
        S.collected_at(F.col("fetched_at")).alias("collected_at"),
        *keep,
    )


def parse_comments(
    items: DataFrame, keep: Sequence[str] = (), salt: str = ""
) -> DataFrame:
    """Comment rows from ``item``, the requested ``video_id``, ``client`` and ``fetched_at``.

    The author leaves as a hash only; ``salt`` is added to it when given.
    """
    r = F.col("r")
    staged = _read_items(
        items, COMMENT_SHAPE, ("cid", "id"), ("video_id", "client", "fetched_at", *keep)
    )
    replies = V.first_of(r["reply_comment_total"], r["replyCommentTotal"], r["reply_total"])
    return staged.select(
        V.to_text(F.col("raw_id")).alias("comment_id"),
        "video_id",
        "client",
        r["text"].alias("text"),
        V.to_int(V.first_of(r["digg_count"], r["diggCount"])).alias("like_count"),
        V.to_int(replies).alias("reply_count"),
        S.parent_comment_id(r).alias("parent_comment_id"),
        S.author_hash(S.comment_author(r), salt).alias("author_hash"),
        S.epoch_to_utc(V.to_int(V.first_of(r["create_time"], r["createTime"]))).alias("created_at"),
        S.collected_at(F.col("fetched_at")).alias("collected_at"),
        *keep,
    )


def video_links(links: DataFrame, link: str = "link", handle: Column | None = None) -> DataFrame:
    """Adds ``video_id``, ``url`` and ``is_valid`` to a column of links or bare ids."""
    found = S.extract_video_id(F.col(link))
    return (
        links.withColumn("video_id", found)
        .withColumn("url", S.video_url(F.col(link), handle))
        .withColumn("is_valid", F.col("video_id").isNotNull())
    )
