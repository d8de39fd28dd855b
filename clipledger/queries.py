"""The runnable catalogue: every job over the test tables, with its expected result as SQL.

Instants leave as UTC wall-clock time and hashtags as comma-joined text, so that results compare
by value whatever the session zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.fixtures import expected as X
from clipledger.fixtures import raw as R
from clipledger.fixtures.cases import CASES
from clipledger.functions import scalars as S
from clipledger.operators import paging as P
from clipledger.operators import profiling, reports
from clipledger.operators.parsing import parse_comments, parse_videos, video_links
from clipledger.operators.replies import reply_expand
from clipledger.operators.resolve import resolve_handles
from clipledger.operators.routing import route_responses, usable
from clipledger.operators.upsert import upsert_latest, with_arrival
from clipledger.plans import ingest
from clipledger.session import configure, scratch_dir
from clipledger.sources import tables
from clipledger.sources.contracts import (
    COMMENT_KEY,
    COMMENT_SCHEMA,
    COMMENTS,
    VIDEO_KEY,
    VIDEO_SCHEMA,
)
from clipledger.sources.landing import from_envelopes, payload_scan
from clipledger.sources.registry import registry_scan
from clipledger.streaming.incremental import ingest_incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Small bounds, so that they bite on the test tables.
TOP_BOUND, REPLY_BOUND, VIDEO_BOUND = 5, 2, 10
THREAD_BOUND = 2


def register(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(job: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return job(configure(spark), sf_dir)

        QUERIES[job.__name__] = run
        if oracle is not None:
            ORACLES[job.__name__] = oracle
        return job

    return add


def plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock time, hashtags as text."""
    kinds = dict(df.dtypes)
    columns = []
    for name in df.columns:
        column = F.col(name)
        if kinds[name] == "timestamp":
            column = S.as_utc_ntz(column)
        elif kinds[name] == "array<string>":
            column = F.array_join(column, ",")
        columns.append(column.alias(name))
    return df.select(*columns)


_LANDED_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


# -- building blocks over the test tables -----------------------------------------------------
def _videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_videos(R.as_items(R.raw_videos(spark, sf_dir)))


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_comments(R.as_items(R.raw_comments(spark, sf_dir)), keep=("part", "supp"))
    return upsert_latest(None, parsed, COMMENT_KEY, order=("part", "supp")).drop("part", "supp")


def _stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows that a report reads more than once, parsed once."""
    path = scratch_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_comments(R.as_items(R.spoken_comments(spark, sf_dir)))


def _usable_pages(spark: SparkSession, envelopes: DataFrame, *unread: str) -> DataFrame:
    """Usable pages, built and parsed once: stitching reads their paging fields, and then the pages themselves."""
    pages = P.page_fields(usable(route_responses(from_envelopes(envelopes))))
    return _stored(spark, pages.drop(*unread), "pages")


def _stitched(spark: SparkSession, sf_dir: str, *unread: str) -> DataFrame:
    return P.page_stitch(_usable_pages(spark, R.comment_pages(spark, sf_dir), *unread))


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.first_seen(P.page_items(_stitched(spark, sf_dir)), COMMENTS.id_keys)


def _item_columns(items: DataFrame, *extra: str) -> DataFrame:
    """Items shown by request, place and the fields that identify them."""
    text = P.V.to_text(P.V.at(F.col("item"), "text"))
    return items.select(
        "video_id",
        P.V.to_text(P.item_id(F.col("item"), COMMENTS.id_keys)).alias("comment_id"),
        text.alias("text"),
        *extra,
    )


# -- parsing ------------------------------------------------------------------------------------
@register(f"{X.with_parts(X.VIDEOS)} SELECT {X.VIDEO_COLUMNS} FROM videos WHERE landed")
def parse_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_videos(spark, sf_dir))


@register(f"{X.with_parts(X.COMMENTS)} SELECT {X.COMMENT_COLUMNS} FROM comments_in WHERE landed")
def parse_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(parse_comments(R.as_items(R.raw_comments(spark, sf_dir))))


@register(
    "SELECT 'd' || doc_id AS video_id, 'c' || source AS client, text AS caption, "
    "lang || chr(10) || '<' || text || '>' AS overlay_text, "
    "'https://www.tiktok.com/@c' || source || '/video/d' || doc_id AS url FROM documents"
)
def parse_video_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as captions and overlays."""
    videos = parse_videos(R.as_items(R.document_videos(spark, sf_dir)))
    return videos.select("video_id", "client", "caption", "overlay_text", "url")


@register(
    "SELECT conv_id || '/' || turn AS comment_id, CAST(conv_id AS VARCHAR) AS video_id, text, "
    "CASE WHEN turn > 0 THEN conv_id || '/0' END AS parent_comment_id, "
    "sha256(role) AS author_hash FROM conversations"
)
def parse_comment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversation turns as comments."""
    return _spoken(spark, sf_dir).select(
        "comment_id", "video_id", "text", "parent_comment_id", "author_hash"
    )


@register(
    "SELECT CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderkey AS VARCHAR) END AS video_id, "
    "CASE o_orderkey % 3 WHEN 0 THEN 'https://www.tiktok.com/@' || "
    "CASE WHEN o_orderkey % 2 = 0 THEN 'u' || o_custkey ELSE 'tiktok' END || '/video/' || o_orderkey "
    "WHEN 1 THEN 'https://t.example/@a/video/' || o_orderkey || '?x=1' END AS url, "
    "o_orderkey % 3 < 2 AS is_valid, "
    "CASE o_orderkey % 3 WHEN 0 THEN chr(9) || o_orderkey || ' ' "
    "WHEN 1 THEN 'https://t.example/@a/video/' || o_orderkey || '?x=1' "
    "ELSE 'no-id-' || o_orderkey END AS link FROM orders"
)
def video_link_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return video_links(R.links(spark, sf_dir), handle=F.col("owner")).drop("owner")


@register(
    f"{X.with_parts(X.VIDEOS)} SELECT video_id, overlay_text IS NOT NULL AS has_overlay, "
    "transcript IS NOT NULL AS has_transcript FROM videos WHERE landed"
)
def has_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _videos(spark, sf_dir).select(
        "video_id",
        S.has_value(F.col("overlay_text")).alias("has_overlay"),
        S.has_value(F.col("transcript")).alias("has_transcript"),
    )


# -- sources and sinks --------------------------------------------------------------------------
@register(
    "SELECT c_name AS client, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE "
    "'https://www.tiktok.com/@u' || c_custkey || repeat('/', CAST(c_custkey % 3 AS INTEGER)) END "
    "AS tiktok, 'https://www.instagram.com/u' || c_custkey AS instagram, "
    "CASE WHEN c_custkey % 10 <> 0 THEN 'u' || c_custkey END AS handle FROM customer"
)
def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "registry")
    R.registry_rows(spark, sf_dir).write.csv(path, header=True)
    return registry_scan(spark, path).drop("row_ord")


_LINED = "'two' || chr(10) || '\"' || c_custkey || '\",' || chr(10) || chr(10) || c_name"


@register(
    f"SELECT {_LINED} AS client, 'https://www.tiktok.com/@u' || c_custkey AS tiktok, "
    "CASE WHEN c_custkey % 3 = 0 THEN 'a' || chr(13) || chr(10) || 'b, ' || c_custkey END AS instagram, "
    "'u' || c_custkey AS handle FROM customer"
)
def registry_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks, commas and quotes inside quoted values, and a byte-order mark before the header."""
    path = scratch_dir(spark, "registry_quoted")
    R.table(spark, sf_dir, "customer").select(
        F.expr("concat('two\\n\"', c_custkey, '\",\\n\\n', c_name)").alias("\ufeffclient"),
        F.expr("concat('https://www.tiktok.com/@u', c_custkey)").alias("tiktok"),
        F.expr("if(c_custkey % 3 = 0, concat('a\\r\\nb, ', c_custkey), null)").alias("instagram"),
    ).write.csv(path, header=True, escape='"')
    return registry_scan(spark, path).drop("row_ord")


@register(
    "SELECT c_name AS identifier, CASE WHEN c_custkey % 10 <> 0 THEN 'u' || c_custkey END AS handle, "
    "c_custkey % 10 <> 0 AS resolved FROM customer UNION ALL "
    "SELECT 'u' || c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN 'u' || c_custkey END, "
    "c_custkey % 10 <> 0 FROM customer UNION ALL "
    "SELECT 'nobody' || o_orderkey, NULL, false FROM orders"
)
def resolve_handle(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "registry")
    R.registry_rows(spark, sf_dir).write.csv(path, header=True)
    return resolve_handles(R.identifiers(spark, sf_dir), registry_scan(spark, path))


@register(
    f"{X.with_parts(X.VIDEOS)} SELECT {X.VIDEO_COLUMNS.replace('share_count', 'CAST(NULL AS BIGINT) AS share_count')} "
    "FROM videos WHERE landed"
)
def contract_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file written without the contract: other order, floats for counts, a column too many and one missing."""
    path = scratch_dir(spark, "drifted")
    videos = _videos(spark, sf_dir)
    drifted = videos.select(
        F.lit("extra").alias("note"),
        *[
            F.col(name).cast("double") if kind == "bigint" else F.col(name)
            for name, kind in reversed(videos.drop("share_count").dtypes)
        ],
    )
    drifted.write.parquet(path)
    return plain(tables.contract_scan(spark, path, VIDEO_SCHEMA))


# Files of one folder by order key: whole numbers, floats, nothing but nulls, no such column.
_MIXED = {
    "like_count": "CASE k % 4 WHEN 0 THEN like_count WHEN 1 THEN like_count END",
    "share_count": "CASE WHEN k % 4 <> 3 THEN share_count END",
    "play_count": "CASE WHEN k % 4 <> 1 THEN play_count END",
}


def _mixed_columns() -> str:
    shown = X.VIDEO_COLUMNS
    for name, expected in _MIXED.items():
        shown = shown.replace(name, f"CAST({expected} AS BIGINT) AS {name}")
    return shown


def _mixed_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Videos written file by file, as a writer without a contract types each batch."""
    videos = _videos(spark, sf_dir)
    part = F.expr("CAST(video_id AS BIGINT) % 4")
    drifts = (
        lambda rows: rows,
        lambda rows: rows.withColumn("like_count", F.col("like_count").cast("double"))
        .withColumn("play_count", F.lit(None).cast("int")),
        lambda rows: rows.withColumn("like_count", F.lit(None).cast("int"))
        .withColumn("comment_count", F.col("comment_count").cast("double")),
        lambda rows: rows.drop("share_count").withColumn("like_count", F.lit(None).cast("double"))
        .select(*reversed(rows.drop("share_count").columns), F.lit(1).alias("note")),
    )
    for number, drift in enumerate(drifts):
        drift(videos.where(part == number)).write.mode("append").parquet(path)


@register(f"{X.with_parts(X.VIDEOS)} SELECT {_mixed_columns()} FROM videos WHERE landed AND k % 97 <> 0")
def contract_scan_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of files whose counts are whole numbers, floats, all null or missing."""
    path = scratch_dir(spark, "mixed")
    _mixed_files(spark, sf_dir, path)
    return plain(tables.contract_scan(spark, path, VIDEO_SCHEMA))


@register(
    f"{X.with_parts(X.VIDEOS)} SELECT client, count(*) AS n, CAST(sum(CASE WHEN k % 4 < 2 THEN like_count END) AS BIGINT) "
    "AS likes, CAST(sum(comment_count) AS BIGINT) AS reported FROM videos WHERE landed AND k % 97 <> 0 GROUP BY client"
)
def table_views_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view over the same files by a glob, then SQL on it."""
    path = scratch_dir(spark, "mixed_views")
    _mixed_files(spark, sf_dir, f"{path}/video")
    tables.table_views(spark, f"{path}/video/*.parquet", f"{path}/comments")
    return spark.sql(
        "SELECT client, count(*) AS n, sum(like_count) AS likes, sum(comment_count) AS reported "
        "FROM video GROUP BY client"
    )


@register(
    f"{X.with_parts(X.VIDEOS, X.COMMENTS, X.LATEST)} "
    "SELECT client, 'video' AS kind, count(*) AS n FROM videos WHERE landed GROUP BY client "
    "UNION ALL SELECT client, 'comments', count(*) FROM comments_now GROUP BY client"
)
def table_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both views over stored files, then one SQL statement on them."""
    path = scratch_dir(spark, "views")
    _videos(spark, sf_dir).write.parquet(f"{path}/video")
    _comments(spark, sf_dir).write.parquet(f"{path}/comments")
    tables.table_views(spark, f"{path}/video", f"{path}/comments")
    return spark.sql(
        "SELECT client, 'video' AS kind, count(*) AS n FROM video GROUP BY client "
        "UNION ALL SELECT client, 'comments', count(*) FROM comments GROUP BY client"
    )


@register(
    f"{X.with_parts(X.COMMENTS, X.LATEST)} SELECT {X.COMMENT_COLUMNS} FROM comments_now"
)
def snapshot_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older half as a snapshot, newer rows added on top, then folded into the next snapshot."""
    root = scratch_dir(spark, "table")
    parsed = parse_comments(R.as_items(R.raw_comments(spark, sf_dir)), keep=("part", "supp"))
    is_first = F.expr("try_cast(substring_index(text, '\\n', -1) AS bigint) % 2 = 0")
    for step, rows in enumerate((parsed.where(is_first), parsed.where(~is_first))):
        batch = upsert_latest(None, rows, COMMENT_KEY, order=("part", "supp")).drop("part", "supp")
        if step == 0:
            tables.snapshot_sink(spark, batch, root, COMMENT_SCHEMA)
        else:
            tables.append_rows(spark, batch, root, COMMENT_SCHEMA, "second")
    tables.compact(spark, root, COMMENT_SCHEMA, COMMENT_KEY)
    return plain(tables.current_table(spark, root, COMMENT_SCHEMA, COMMENT_KEY))


@register(
    f"{X.with_parts(X.COMMENTS, X.PAGED)} SELECT CAST(k AS VARCHAR) AS video_id, "
    "CAST(CASE WHEN k % 10 = 3 AND n >= 3 THEN n // 3 + 1 ELSE n // 3 END AS INTEGER) AS page_seq, "
    "client, 'ok' AS route, max(shipped) AS fetched_at FROM numbered GROUP BY ALL "
    "UNION ALL SELECT CAST(k AS VARCHAR), 1, client, 'ok', max(shipped) FROM numbered "
    "WHERE k % 10 = 3 AND n < 3 GROUP BY ALL"
)
def payload_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed as JSON lines, read back as VARIANT, routed."""
    path = scratch_dir(spark, "landing")
    R.comment_pages(spark, sf_dir).write.json(path, timestampFormat=_LANDED_TIME, compression="gzip")
    routed = route_responses(payload_scan(spark, path))
    return plain(routed.select("video_id", "page_seq", "client", "route", "fetched_at"))


_LANDED_LINE = (
    "CASE page_id % 4 WHEN 0 THEN '{{\"client\":\"c' || page_id || '\",\"http_status\":200,\"body\":{{}}}}' "
    "WHEN 1 THEN '{{\"client\":\"c' || page_id || '\",\"body\":\"' || {text} "
    "WHEN 2 THEN '[' || page_id || ']' ELSE 'x ' || {text} END"
)


@register(
    f"WITH lines AS (SELECT page_id, {_LANDED_LINE.format(text='translate(html, chr(10) || chr(13), chr(32) || chr(32))')} "
    "AS line FROM pages) SELECT CASE WHEN page_id % 4 = 0 THEN 'c' || page_id END AS client, "
    "CASE page_id % 4 WHEN 0 THEN 'ok' ELSE 'terminal' END AS route, "
    "CASE page_id % 4 WHEN 0 THEN NULL WHEN 2 THEN 'broken line: not an object' ELSE 'broken line: not JSON' END AS message, "
    "page_id % 4 <> 0 AS has_file, CASE WHEN page_id % 4 <> 0 THEN CAST(strlen(line) AS BIGINT) END AS length, "
    "CASE WHEN page_id % 4 <> 0 THEN sha256(line) END AS sha256 FROM lines"
)
def payload_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut in the middle, of another shape or no JSON at all, among good ones."""
    path = scratch_dir(spark, "broken")
    line = _LANDED_LINE.format(text="translate(html, '\\n\\r', '  ')")
    R.table(spark, sf_dir, "pages").select(F.expr(line)).write.text(path)
    routed = route_responses(payload_scan(spark, path))
    return routed.select(
        "client",
        "route",
        "message",
        F.coalesce(F.col("broken.file").contains("/broken-"), F.lit(False)).alias("has_file"),
        "broken.length",
        "broken.sha256",
    )


@register(
    "SELECT CAST(page_id AS VARCHAR) AS video_id, "
    "CASE page_id % 7 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 5 THEN 'transient' "
    "WHEN 6 THEN 'transient' ELSE 'terminal' END AS route, "
    "CASE WHEN page_id % 7 < 2 THEN NULL WHEN page_id % 7 = 2 THEN 'bad JSON' "
    "WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN html "
    "ELSE '<' || html END AS message, "
    "CAST(CASE page_id % 7 WHEN 0 THEN 1 ELSE 0 END AS INTEGER) AS items FROM pages"
)
def response_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_responses(from_envelopes(R.responses(spark, sf_dir)))
    items = F.size(P.V.list_at(F.col("payload"), "comments"))
    return routed.select("video_id", "route", "message", items.alias("items"))


# -- paging -------------------------------------------------------------------------------------
@register(
    f"{X.with_parts(X.COMMENTS, X.PAGED)} SELECT video_id, CAST(page_seq AS INTEGER) AS page_seq, "
    "CAST(count(*) AS INTEGER) AS n_items FROM paged GROUP BY ALL"
)
def page_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stitched(spark, sf_dir, "items").select("video_id", "page_seq", "n_items")


_ITEM = "video_id, CASE WHEN landed THEN comment_id END AS comment_id, text"


@register(
    f"{X.with_parts(X.COMMENTS, X.PAGED)} SELECT {_ITEM}, page_seq * 2147483648 + n % 3 AS ord "
    "FROM paged"
)
def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_columns(P.page_items(_stitched(spark, sf_dir)), "ord")


@register(f"{X.with_parts(X.COMMENTS, X.PAGED, X.SEEN)} SELECT {_ITEM} FROM seen")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_columns(_seen(spark, sf_dir))


@register(
    f"{X.with_parts(X.COMMENTS, X.PAGED, X.SEEN, X.TAKEN.format(count=TOP_BOUND))} "
    f"SELECT {_ITEM} FROM taken"
)
def bounded_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_columns(P.bounded_take(_seen(spark, sf_dir), TOP_BOUND))


_THREADS = X.THREADS.format(tops=THREAD_BOUND, replies=REPLY_BOUND)


@register(
    f"{X.with_parts(X.COMMENTS, _THREADS)} SELECT {_ITEM}, CAST(is_reply AS INTEGER) AS is_reply, "
    "coalesce(parent, '') AS thread_id FROM thread_items"
)
def reply_expand_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    tops = P.page_items(P.page_stitch(_usable_pages(spark, R.thread_comment_pages(spark, sf_dir))))
    kept = P.bounded_take(P.first_seen(tops, COMMENTS.id_keys), THREAD_BOUND)
    expanded = reply_expand(kept, _usable_pages(spark, R.reply_pages(spark, sf_dir)), REPLY_BOUND)
    return _item_columns(expanded, "is_reply", "thread_id")


# The same building blocks with bounds that no group can reach: everything that landed.
_ALL = 9223372036854775807
_ALL_THREADS = X.THREADS.format(tops=_ALL, replies=_ALL)


@register(
    f"{X.with_parts(X.COMMENTS, _ALL_THREADS)} SELECT {_ITEM}, CAST(is_reply AS INTEGER) AS is_reply, "
    "coalesce(parent, '') AS thread_id FROM thread_items"
)
def reply_expand_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    tops = P.page_items(P.page_stitch(_usable_pages(spark, R.thread_comment_pages(spark, sf_dir))))
    kept = P.first_seen(tops, COMMENTS.id_keys)
    expanded = reply_expand(kept, _usable_pages(spark, R.reply_pages(spark, sf_dir)))
    return _item_columns(expanded, "is_reply", "thread_id")


# -- upsert and reports ---------------------------------------------------------------------------
@register(
    f"{X.with_parts(X.COMMENTS, X.LATEST)} SELECT {X.COMMENT_COLUMNS} FROM comments_now"
)
def upsert_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_comments(spark, sf_dir))


def _upsert_events(spark: SparkSession, sf_dir: str, time: str) -> DataFrame:
    events = R.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props",
        F.expr(time).alias("collected_at"),
    )
    merged = upsert_latest(
        events.where("event_id % 2 = 0"),
        events.where("event_id % 2 = 1"),
        "user_id",
        scope=(),
        order=("event_id",),
    )
    return merged


_NEWEST = (
    "SELECT event_id, user_id, event_type, value, props, collected_at FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY collected_at DESC NULLS FIRST, "
    "event_id % 2 DESC, event_id DESC) AS place FROM (SELECT *, {time} AS collected_at FROM events)) "
    "WHERE place = 1"
)


@register(_NEWEST.format(time="ts"))
def upsert_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_events(spark, sf_dir, "ts")


@register(_NEWEST.format(time="CASE WHEN event_id % 100 > 1 THEN ts END"))
def upsert_null_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows carry no time; they count as newest, and incoming ones beat stored ones."""
    return _upsert_events(spark, sf_dir, "CASE WHEN event_id % 100 > 1 THEN ts END")


@register(
    "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER ("
    "PARTITION BY user_id ORDER BY event_id % 2 DESC, event_id DESC) AS place FROM events) WHERE place = 1"
)
def upsert_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one time and no order column: what stands later in the files wins, wherever it is then sent."""
    path = scratch_dir(spark, "arrival")
    events = R.table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", "value", F.lit(0).cast("timestamp").alias("collected_at")
    )
    stored = upsert_latest(None, events.where("event_id % 2 = 0"), "user_id", scope=(), order=("event_id",))
    incoming = events.where("event_id % 2 = 1").repartitionByRange("event_id").sortWithinPartitions("event_id")
    incoming.write.parquet(path)
    arrived = with_arrival(spark.read.parquet(path)).repartition(7)
    return upsert_latest(stored, arrived, "user_id", scope=()).drop("collected_at")


@register(
    f"{X.with_parts(X.VIDEOS, X.COMMENTS, X.LATEST)} SELECT "
    "(SELECT count(*) FROM videos WHERE landed) AS videos, count(*) AS comments, "
    "count(*) - count(parent_comment_id) AS top_level, count(parent_comment_id) AS replies "
    "FROM comments_now"
)
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_counts(_videos(spark, sf_dir), _comments(spark, sf_dir))


@register(
    f"{X.with_parts(X.VIDEOS, X.COMMENTS, X.LATEST)} SELECT v.client, v.video_id, "
    "any_value(v.like_count) AS like_count, any_value(v.comment_count) AS reported_comments, "
    "count(c.comment_id) AS collected_comments, v.overlay_text IS NOT NULL AS has_overlay, "
    "v.transcript IS NOT NULL AS has_transcript "
    "FROM (SELECT * FROM videos WHERE landed) v LEFT JOIN comments_now c "
    "ON v.client = c.client AND v.video_id = c.video_id "
    "GROUP BY v.client, v.video_id, v.overlay_text, v.transcript"
)
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage_report(_videos(spark, sf_dir), _comments(spark, sf_dir))


@register(
    "SELECT 'talk' AS client, CAST(conv_id AS VARCHAR) AS video_id, conv_id || '/0' AS comment_id, "
    "CAST(NULL AS BIGINT) AS reported_replies, count(*) FILTER (turn > 0) AS replies "
    "FROM conversations GROUP BY conv_id HAVING count(*) FILTER (turn = 0) > 0"
)
def conversation_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.comment_threads(_spoken(spark, sf_dir)).drop(
        "reply_likes", "first_reply_at", "last_reply_at"
    )


@register(
    f"{X.with_parts(X.COMMENTS, X.LATEST)} SELECT p.client, p.video_id, p.comment_id, "
    "CAST(NULL AS BIGINT) AS reported_replies, count(r.comment_id) AS replies, "
    "CAST(sum(r.like_count) AS BIGINT) AS reply_likes, min(r.created_at) AS first_reply_at, "
    "max(r.created_at) AS last_reply_at FROM comments_now p LEFT JOIN comments_now r "
    "ON r.client = p.client AND r.video_id = p.video_id AND r.parent_comment_id = p.comment_id "
    "WHERE p.parent_comment_id IS NULL GROUP BY p.client, p.video_id, p.comment_id"
)
def comment_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.comment_threads(_comments(spark, sf_dir)))


@register(
    f"{X.with_parts(X.COMMENTS, X.LATEST)} SELECT r.comment_id, r.video_id, r.parent_comment_id, "
    "r.text, p.text AS parent_text, p.author_hash AS parent_author_hash FROM comments_now r "
    "LEFT JOIN comments_now p ON r.client = p.client AND r.video_id = p.video_id "
    "AND r.parent_comment_id = p.comment_id WHERE r.parent_comment_id IS NOT NULL"
)
def thread_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = _stored(spark, _comments(spark, sf_dir), "thread_rows")
    return reports.thread_rows(comments).select(
        "comment_id", "video_id", "parent_comment_id", "text", "parent_text", "parent_author_hash"
    )


@register(
    f"{X.with_parts(X.COMMENTS, X.LATEST)} SELECT {X.COMMENT_COLUMNS} FROM comments_now r "
    "WHERE parent_comment_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM comments_now p "
    "WHERE p.client = r.client AND p.comment_id = r.parent_comment_id)"
)
def orphan_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.orphan_replies(_comments(spark, sf_dir)))


@register(
    f"{X.with_parts(X.VIDEOS, X.COMMENTS, X.LATEST)} SELECT v.client, v.video_id, v.caption, "
    "v.overlay_text IS NOT NULL AS overlay_text_present, false AS transcript_present, "
    "v.comment_count AS reported_comment_count, "
    "(SELECT count(*) FROM comments_in c WHERE c.landed AND c.k = v.k) AS comments_collected, "
    "count(*) OVER (PARTITION BY v.client) AS video_rows_total, "
    "coalesce(t.n, 0) AS comment_rows_total FROM videos v "
    "LEFT JOIN (SELECT client, count(*) AS n FROM comments_now GROUP BY client) t "
    "ON v.client = t.client WHERE v.landed"
)
def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    videos = _stored(spark, _videos(spark, sf_dir), "summary_videos")
    parsed = parse_comments(R.as_items(R.raw_comments(spark, sf_dir)), keep=("part", "supp"))
    counted = ("client", "video_id", COMMENT_KEY, "collected_at", "part", "supp")
    batch = _stored(spark, parsed.select(*counted), "summary_comments")
    stored = upsert_latest(None, batch, COMMENT_KEY, order=("part", "supp"))
    return reports.ingest_summary(videos, batch, videos, stored)


# -- profiling ------------------------------------------------------------------------------------
def _paths(*rows: tuple[str, str, str, str]) -> str:
    """Profile rows as (path, type, condition on orders, mean length)."""
    parts = [
        f"SELECT '{path}' AS path, '{kind}' AS type, count(*) FILTER ({when}) AS documents, "
        f"CAST({length} AS DOUBLE) AS mean_length FROM orders"
        for path, kind, when, length in rows
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE documents > 0"


def _video_shape() -> str:
    def d(*dialects: int) -> str:
        return f"o_orderkey % 4 IN ({', '.join(map(str, dialects))})"

    has, none = "o_orderkey % 97 <> 0", "o_orderkey % 97 = 0"
    rows = [
        ("id", "str", f"{d(0, 3)} AND {has}"), ("id", "null", f"{d(0, 3)} AND {none} OR {d(2)}"),
        ("aweme_id", "int", f"{d(1, 2)} AND {has}"), ("aweme_id", "null", f"{d(1, 2)} AND {none}"),
        ("createTime", "str", d(0, 3)), ("create_time", "int", d(1, 2)),
        ("desc", "str", d(0, 3)), ("desc", "null", d(1)), ("content_desc", "str", d(1, 3)),
        ("stats.diggCount", "int", d(0)), ("stats.commentCount", "int", d(0)),
        ("stats.shareCount", "int", d(0)), ("stats.playCount", "null", d(0)),
        ("stats", "dict", d(3)),
        ("statistics.digg_count", "int", d(1)), ("statistics.digg_count", "null", d(2)),
        ("statistics.comment_count", "int", d(1)), ("statistics.comment_count", "float", d(2)),
        ("statistics.share_count", "int", d(1)), ("statistics.share_count", "str", d(2)),
        ("statistics.play_count", "int", d(1)), ("statistics.play_count", "bool", d(2)),
        ("statsV2.diggCount", "str", d(3)), ("statsV2.commentCount", "str", d(3)),
        ("statsV2.shareCount", "int", d(3)), ("statsV2.playCount", "str", d(3)),
        ("textExtra", "list", d(0), "4"), ("textExtra[0].hashtagName", "str", d(0)),
        ("textExtra", "null", d(3)),
        ("text_extra", "list", d(1), "2"), ("text_extra[0].hashtag_name", "str", d(1)),
        ("content_desc_extra", "list", d(1), "2"),
        ("content_desc_extra[0].hashtag_name", "str", d(1)),
        ("stickersOnItem", "list", d(0, 3), "1"),
        ("stickersOnItem[0].stickerText", "list", d(0, 3),
         f"2.0 * count(*) FILTER ({d(0)}) / count(*) FILTER ({d(0, 3)}) "
         f"+ 1.0 * count(*) FILTER ({d(3)}) / count(*) FILTER ({d(0, 3)})"),
        ("stickersOnItem[0].stickerText[0]", "str", d(0, 3)),
        ("contents", "list", d(1, 3),
         f"2.0 * count(*) FILTER ({d(1)}) / count(*) FILTER ({d(1, 3)}) "
         f"+ 1.0 * count(*) FILTER ({d(3)}) / count(*) FILTER ({d(1, 3)})"),
        ("contents[0].desc", "str", d(1, 3)),
        ("music.title", "str", d(0)), ("music", "dict", d(1)), ("music.author", "str", d(3)),
        ("added_sound_music_info.title", "str", d(1, 3)),
        ("video.duration", "int", d(0)), ("video.duration", "str", d(1)),
        ("video.duration", "float", d(3)),
        ("author.uniqueId", "str", d(0, 3)), ("author.unique_id", "str", d(1)),
    ]
    return _paths(*[row if len(row) == 4 else (*row, "NULL") for row in rows])


@register(
    "SELECT path, type, documents, round(mean_length, 6) AS mean_length FROM ("
    + _video_shape() + ")"
)
def json_shape_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = R.as_items(R.raw_videos(spark, sf_dir))
    return profiling.json_shape_profile(documents, "item").withColumn(
        "mean_length", F.round("mean_length", 6)
    )


@register(
    "SELECT 'k' AS path, 'int' AS type, count(*) AS documents, CAST(NULL AS DOUBLE) AS mean_length "
    "FROM events WHERE props IS NOT NULL"
)
def json_shape_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = R.table(spark, sf_dir, "events").select(F.try_parse_json("props").alias("raw"))
    return profiling.json_shape_profile(documents)


_DEEPEST = 300


@register(
    "WITH depths AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN 300 ELSE c_custkey % 6 + 1 END AS depth FROM customer) "
    "SELECT repeat('a.', CAST(depth - 1 AS INTEGER)) || 'a' AS path, 'int' AS type, count(*) AS documents, "
    "CAST(NULL AS DOUBLE) AS mean_length FROM depths GROUP BY depth "
    "UNION ALL SELECT repeat('a.', CAST(level - 1 AS INTEGER)) || 'l', 'list', count(*), 2.0 FROM depths, "
    "(SELECT unnest(range(1, 301)) AS level) WHERE level <= depth GROUP BY level "
    "UNION ALL SELECT repeat('a.', CAST(level - 1 AS INTEGER)) || 'l[0]', 'str', count(*), NULL FROM depths, "
    "(SELECT unnest(range(1, 301)) AS level) WHERE level <= depth GROUP BY level"
)
def json_shape_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects within objects, 1 to 300 of them, with a list at every level; one document in fifty is the deepest."""
    depth = F.expr(f"CASE WHEN c_custkey % 50 = 0 THEN {_DEEPEST} ELSE int(c_custkey % 6 + 1) END")
    text = F.concat(F.repeat(F.lit('{"l":["x",1],"a":'), depth), F.col("c_custkey"), F.repeat(F.lit("}"), depth))
    documents = R.table(spark, sf_dir, "customer").select(F.parse_json(text).alias("raw"))
    return profiling.json_shape_profile(documents)


@register(
    "SELECT 'u' || o_custkey AS client, 'https://www.tiktok.com/@u' || o_custkey || '/video/' || "
    "arg_min(o_orderkey, n) FILTER (o_orderkey % 97 <> 0) AS first_video_url FROM ("
    "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) "
    "- 1 AS n FROM orders) GROUP BY o_custkey, n // 4"
)
def first_video_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = R.profile_pages(spark, sf_dir).select("client", F.parse_json("body").alias("raw"))
    return profiling.first_video_link(pages, "raw", F.col("client")).drop("raw")


# -- ingestion --------------------------------------------------------------------------------------
_LANDED_VIDEOS = """
swept AS (
  SELECT *, max(day) OVER (PARTITION BY cust, n // 4) AS page_time FROM (
    SELECT *, row_number() OVER (PARTITION BY cust ORDER BY day DESC, k DESC) - 1 AS n FROM videos)),
swept_videos AS (SELECT * FROM swept WHERE landed AND n < {count})"""

_SWEPT_COMMENTS = """
page_times AS (SELECT k, n // 3 AS page, max(shipped) AS page_time FROM numbered GROUP BY ALL),
swept_comments AS (
  SELECT t.*, p.page_time FROM taken t JOIN page_times p ON t.k = p.k AND t.n // 3 = p.page
  WHERE t.landed AND t.k IN (SELECT k FROM swept_videos))"""

_SWEEP = X.with_parts(
    X.VIDEOS,
    X.COMMENTS,
    X.PAGED,
    X.SEEN,
    X.TAKEN.format(count=TOP_BOUND),
    _LANDED_VIDEOS.format(count=VIDEO_BOUND),
    _SWEPT_COMMENTS,
)

_SWEEP_ALL = X.with_parts(
    X.VIDEOS,
    X.COMMENTS,
    X.PAGED,
    X.SEEN,
    X.TAKEN.format(count=_ALL),
    _LANDED_VIDEOS.format(count=_ALL),
    _SWEPT_COMMENTS,
)

_SUMMARY = (
    "SELECT v.client, v.video_id, v.caption, v.overlay_text IS NOT NULL AS overlay_text_present, "
    "false AS transcript_present, v.comment_count AS reported_comment_count, "
    "coalesce(c.n, 0) AS comments_collected, "
    "count(*) OVER (PARTITION BY v.client) AS video_rows_total, "
    "CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY v.client) AS BIGINT) AS comment_rows_total "
    "FROM {videos} v LEFT JOIN (SELECT k, count(*) AS n FROM {comments} GROUP BY k) c ON v.k = c.k"
)


@register(f"{_SWEEP} {_SUMMARY.format(videos='swept_videos', comments='swept_comments')}")
def ingest_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every creator's newest videos with their comments; the summary of the run."""
    landed = R.profile_pages(spark, sf_dir).unionByName(R.comment_pages(spark, sf_dir))
    return ingest.ingest_sweep(
        spark,
        from_envelopes(landed),
        scratch_dir(spark, "sweep"),
        max_videos=VIDEO_BOUND,
        comment_count=TOP_BOUND,
    )


@register(f"{_SWEEP_ALL} {_SUMMARY.format(videos='swept_videos', comments='swept_comments')}")
def ingest_sweep_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every video of every creator with all its comments; the summary of the run."""
    landed = R.profile_pages(spark, sf_dir).unionByName(R.comment_pages(spark, sf_dir))
    return ingest.ingest_sweep(spark, from_envelopes(landed), scratch_dir(spark, "sweep_all"))


_THREAD_INGEST = X.with_parts(X.VIDEOS, X.COMMENTS, _THREADS)
_WANTED = "(SELECT * FROM videos WHERE landed)"
_WANTED_ITEMS = (
    "(SELECT i.* FROM thread_items i JOIN videos v ON i.k = v.k WHERE i.landed AND v.landed)"
)


@register(f"{_THREAD_INGEST} {_SUMMARY.format(videos=_WANTED, comments=_WANTED_ITEMS)}")
def ingest_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every requested video with its comments and reply threads; the summary of the run."""
    landed = (
        R.video_responses(spark, sf_dir)
        .unionByName(R.thread_comment_pages(spark, sf_dir))
        .unionByName(R.reply_pages(spark, sf_dir))
    )
    return ingest.ingest_video(
        spark,
        from_envelopes(landed),
        scratch_dir(spark, "slice"),
        comment_count=THREAD_BOUND,
        include_replies=True,
        max_replies=REPLY_BOUND,
    )


_THREAD_INGEST_ALL = X.with_parts(X.VIDEOS, X.COMMENTS, _ALL_THREADS)


@register(f"{_THREAD_INGEST_ALL} {_SUMMARY.format(videos=_WANTED, comments=_WANTED_ITEMS)}")
def ingest_video_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every requested video with all its comments and replies; the summary of the run."""
    landed = (
        R.video_responses(spark, sf_dir)
        .unionByName(R.thread_comment_pages(spark, sf_dir))
        .unionByName(R.reply_pages(spark, sf_dir))
    )
    return ingest.ingest_video(
        spark, from_envelopes(landed), scratch_dir(spark, "slice_all"), include_replies=True
    )


# The second crawl finds the same videos a day later, and 1000 likes more on a third of them.
_LIKES = "bigint(l_quantity) + 1000"


def _second_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = R.profile_pages(spark, sf_dir, "r2").unionByName(
        R.comment_pages(spark, sf_dir, "r2", _LIKES).where("bigint(video_id) % 3 = 0")
    )
    # In seconds: adding an interval of a day would follow the session zone's clock changes.
    return later.withColumn(
        "fetched_at", F.timestamp_seconds(F.unix_seconds("fetched_at") + 86400)
    )


_STREAMED = (
    "SELECT comment_id, video_id, client, text, parent_comment_id, author_hash, created_at, "
    "reply_count, CASE WHEN k % 3 = 0 THEN like_count + 1000 ELSE like_count END AS like_count, "
    "CASE WHEN k % 3 = 0 THEN page_time + INTERVAL 1 DAY ELSE page_time END AS collected_at "
    "FROM swept_comments"
)


def _stream(spark: SparkSession, sf_dir: str, name: str, **bounds: int) -> DataFrame:
    base = scratch_dir(spark, name)
    landing, root, state = f"{base}/landing", f"{base}/tables", f"{base}/state"
    first = R.profile_pages(spark, sf_dir).unionByName(R.comment_pages(spark, sf_dir))
    for crawl in (first, _second_crawl(spark, sf_dir)):
        crawl.write.mode("append").json(landing, timestampFormat=_LANDED_TIME, compression="gzip")
        ingest_incremental(spark, landing, root, state, **bounds)
    return plain(ingest.current_comments(spark, root))


@register(f"{_SWEEP} {_STREAMED}")
def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two crawls landed as JSON files, picked up by the stream in two calls."""
    return _stream(spark, sf_dir, "stream", max_videos=VIDEO_BOUND, comment_count=TOP_BOUND)


@register(f"{_SWEEP_ALL} {_STREAMED}")
def ingest_stream_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two crawls without bounds."""
    return _stream(spark, sf_dir, "stream_all")


# -- expressions ------------------------------------------------------------------------------------
for _name, _case in CASES.items():
    _case_query = _case.query
    QUERIES[_name] = lambda spark, sf_dir, run=_case_query: run(configure(spark), sf_dir)
    ORACLES[_name] = _case.oracle()
