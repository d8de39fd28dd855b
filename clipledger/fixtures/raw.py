"""Raw items and landed pages derived from the test tables.

Orders stand for videos (four dialects by order key), line items for their comments (two
dialects by line number), customers for creators. The shapes are described in FIXTURES.md; the
expected results in ``clipledger.fixtures.expected`` come from the same tables without any JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipledger.functions import scalars as S
from clipledger.sources import files

_ALL_FIELDS = "map('ignoreNullFields', 'false')"
_EPOCH = "(datediff(date({0}), DATE'1970-01-01') * 86400L + hour({0}) * 3600 + minute({0}) * 60 + second({0}))"


# Bytes of a stored table that a task gets where it turns each row into text right away: about 200,000 rows.
TASK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str, task_bytes: int | None = None) -> DataFrame:
    """A test table, over all cores.

    The small tables are one Parquet row group each, which is one task. They are spread round
    robin, so that no key decides where rows go; a scan with enough tasks is left alone. Given ``task_bytes``, there are
    as many tasks as it takes for each to get no more, so that the longest one doesn't grow with the table.
    """
    path = f"{sf_dir}/{name}.parquet"
    scan = spark.read.parquet(path)
    tasks = spark.sparkContext.defaultParallelism
    if task_bytes:
        tasks = max(tasks, files.size(spark, path) // task_bytes)
    return scan if scan.rdd.getNumPartitions() >= tasks else scan.repartition(tasks)


VIDEO_JSON = f"""
CASE o_orderkey % 4
WHEN 0 THEN to_json(named_struct(
  'id', if(o_orderkey % 97 = 0, null, string(o_orderkey)),
  'createTime', string({_EPOCH.format('o_orderdate')}),
  'desc', o_orderpriority,
  'stats', named_struct('diggCount', bigint(floor(o_totalprice)), 'commentCount', o_orderkey % 20,
                        'shareCount', o_orderkey % 7, 'playCount', cast(null as bigint)),
  'textExtra', array(named_struct('hashtagName', concat('p', o_orderkey % 3)),
                     named_struct('hashtagName', concat('p', o_orderkey % 3)),
                     named_struct('hashtagName', ''),
                     named_struct('hashtagName', cast(null as string))),
  'stickersOnItem', array(named_struct('stickerText', array(' hi ', ''))),
  'music', named_struct('title', concat('m', o_orderkey % 5)),
  'video', named_struct('duration', o_orderkey % 60),
  'author', named_struct('uniqueId', concat('h', o_custkey))), {_ALL_FIELDS})
WHEN 1 THEN to_json(named_struct(
  'aweme_id', if(o_orderkey % 97 = 0, null, o_orderkey),
  'create_time', {_EPOCH.format('o_orderdate')},
  'desc', cast(null as string),
  'content_desc', o_orderpriority,
  'statistics', named_struct('digg_count', bigint(floor(o_totalprice)),
                             'comment_count', o_orderkey % 20, 'share_count', o_orderkey % 7,
                             'play_count', 100 * o_orderkey),
  'text_extra', array(named_struct('hashtag_name', 'a'), named_struct('hashtag_name', 'b')),
  'content_desc_extra', array(named_struct('hashtag_name', 'b'), named_struct('hashtag_name', 'c')),
  'contents', array(named_struct('desc', 'l1'), named_struct('desc', ' ')),
  'music', map(),
  'added_sound_music_info', named_struct('title', concat('n', o_orderkey % 5)),
  'video', named_struct('duration', string(o_orderkey % 60)),
  'author', named_struct('unique_id', concat('h', o_custkey))), {_ALL_FIELDS})
WHEN 2 THEN to_json(named_struct(
  'id', cast(null as string),
  'aweme_id', if(o_orderkey % 97 = 0, null, o_orderkey),
  'create_time', {_EPOCH.format('o_orderdate')} * if(o_orderkey % 20 = 2, 1000, 1),
  'statistics', named_struct('digg_count', cast(null as bigint), 'comment_count', 12.9D,
                             'share_count', 'abc', 'play_count', true)), {_ALL_FIELDS})
ELSE to_json(named_struct(
  'id', if(o_orderkey % 97 = 0, null, string(o_orderkey)),
  'createTime', if(o_orderkey % 20 = 3, 'abc', string({_EPOCH.format('o_orderdate')})),
  'desc', '',
  'content_desc', 'x',
  'stats', map(),
  'statsV2', named_struct('diggCount', string(o_orderkey), 'commentCount', '12.5',
                          'shareCount', 0, 'playCount', ' 7 '),
  'textExtra', cast(null as array<string>),
  'stickersOnItem', array(named_struct('stickerText', array('s'))),
  'contents', array(named_struct('desc', 'c')),
  'music', named_struct('author', 'someone'),
  'added_sound_music_info', named_struct('title', 'not used'),
  'video', named_struct('duration', 12.7D),
  'author', named_struct('uniqueId', '')), {_ALL_FIELDS})
END"""

_HANDLE = "if(l_suppkey % 7 = 0 AND l_suppkey % 5 <> 0, null, concat('s', l_suppkey))"
_COMMENT_ID = "if(l_partkey % 101 = 0, null, concat(l_orderkey, '-', l_linenumber))"
_TEXT = "concat(l_returnflag, ' \"', l_linestatus, '\" \\n', l_partkey)"


def comment_json(parent: str, replies: str = "bigint(null)", likes: str = "bigint(l_quantity)") -> str:
    """Comment JSON by line number: odd ones in native names, even ones in web names."""
    uid = f"if(l_suppkey % 5 = 0, {_HANDLE}, null)"

    def user(name: str) -> str:
        handle = f"if(l_suppkey % 5 = 0, '', {_HANDLE})"
        return f"if({_HANDLE} is null, null, named_struct('{name}', {handle}))"

    created = _EPOCH.format("l_shipdate")
    return f"""
CASE l_linenumber % 2
WHEN 1 THEN to_json(named_struct(
  'cid', {_COMMENT_ID}, 'create_time', {created}, 'text', {_TEXT}, 'digg_count', {likes},
  'reply_comment_total', {replies}, 'reply_id', {parent},
  'user', {user('unique_id')}, 'uid', {uid}), {_ALL_FIELDS})
ELSE to_json(named_struct(
  'id', {_COMMENT_ID}, 'createTime', string({created}), 'text', {_TEXT}, 'diggCount', {likes},
  'reply_comment_total', {replies}, 'replyId', {parent},
  'user', {user('uniqueId')}, 'uid', {uid}), {_ALL_FIELDS})
END"""


def raw_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw video per order: k, client, body (JSON text), fetched_at."""
    return _video_texts(table(spark, sf_dir, "orders", TASK_BYTES))


def _video_texts(orders: DataFrame, *extra: str) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("k"),
        F.expr("concat('u', o_custkey)").alias("client"),
        F.expr(VIDEO_JSON).alias("body"),
        S.from_utc_ntz(F.col("o_orderdate")).alias("fetched_at"),
        "o_orderdate",
        *extra,
    )


def _commented(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As they are scanned: rows go by their order next, and spreading them first would shuffle all of them once more.
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), F.expr("concat('u', o_custkey)").alias("client")
    )
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(orders, "l_orderkey")


# A line answers the first line of its order; the first one is top-level.
FIRST_LINE = "if(l_linenumber = 1, '0', concat(l_orderkey, '-1'))"


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw comment per line item, fetched when it was shipped."""
    return _commented(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("video_id"),
        "client",
        F.expr(comment_json(FIRST_LINE)).alias("body"),
        S.from_utc_ntz(F.col("l_shipdate")).alias("fetched_at"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
    )


def as_items(raw: DataFrame) -> DataFrame:
    return raw.withColumn("item", F.parse_json("body")).drop("body")


def _pages(
    items: DataFrame, request: list[str], size: int, items_key: str, cursor_key: str
) -> DataFrame:
    """Well-formed pages of ``size`` items from numbered items (``n``, ``body``, ``total``)."""
    numbered = items.withColumn("page_seq", F.expr(f"int(n div {size})"))
    page = numbered.groupBy(*request, "page_seq").agg(
        F.sort_array(F.collect_list(F.struct("n", "body"))).alias("rows"),
        F.max("fetched_at").alias("fetched_at"),
        F.max("total").alias("total"),
    )
    listed = "array_join(transform(rows, r -> r.body), ',')"
    return page.select(
        *request,
        "page_seq",
        F.expr(f"bigint(page_seq * {size})").alias("request_cursor"),
        F.expr(f"if((page_seq + 1) * {size} < total, 1, 0)").alias("more"),
        F.expr(f"bigint((page_seq + 1) * {size})").alias("next"),
        F.expr(f"concat('\"{items_key}\":[', {listed}, ']')").alias("listed"),
        F.lit(cursor_key).alias("cursor_key"),
        "fetched_at",
    )


def _envelope(pages: DataFrame, endpoint: str, run_id: str = "r1") -> DataFrame:
    """Pages as landed responses."""
    have = set(pages.columns)
    text = [
        (F.col(name) if name in have else F.lit(None)).cast("string").alias(name)
        for name in ("client", "video_id", "parent_comment_id")
    ]
    body = (
        F.col("body")
        if "body" in have
        else F.expr(
            "concat('{', listed, ',\"has_more\":', more, "
            "if(next is null, '', concat(',\"', cursor_key, '\":', next)), '}')"
        )
    )
    return pages.select(
        F.lit(run_id).alias("run_id"),
        F.lit(endpoint).alias("endpoint"),
        *text,
        F.col("page_seq"),
        "request_cursor",
        F.lit(200).alias("http_status"),
        body.alias("body"),
        "fetched_at",
    )


def _numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    by = Window.partitionBy(*keys)
    return rows.withColumn("n", F.row_number().over(by.orderBy(*order)) - 1).withColumn(
        "total", F.count("*").over(by)
    )


COMMENT_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]


def comment_pages(
    spark: SparkSession, sf_dir: str, run_id: str = "r1", likes: str = "bigint(l_quantity)"
) -> DataFrame:
    """Comment pages of three, misbehaving by order key % 10.

    1: has_more = 0 on page 1 already · 2: page 1 repeats its cursor · 3: an empty page 1 before
    the rest · 4: no cursor on page 0. All pages are landed; the surplus must not count.
    """
    rows = _numbered(_commented(spark, sf_dir), ["l_orderkey"], COMMENT_ORDER).select(
        F.col("l_orderkey").cast("string").alias("video_id"),
        F.col("l_orderkey").alias("k"),
        "client",
        "n",
        "total",
        F.expr(comment_json(FIRST_LINE, likes=likes)).alias("body"),
        S.from_utc_ntz(F.col("l_shipdate")).alias("fetched_at"),
    )
    pages = _pages(rows, ["client", "video_id", "k"], 3, "comments", "cursor")
    late = F.expr("k % 10 = 3 AND page_seq >= 1")
    # The empty page comes from the page before it: a union would build all pages a second time for it.
    kinds = F.expr("if(k % 10 = 3 AND page_seq = 0, array(false, true), array(false))")
    pages = pages.select("*", F.explode(kinds).alias("empty"))
    landed = (
        pages.withColumn("more", F.expr("if(empty, 1, if(k % 10 = 1 AND page_seq = 1, 0, more))"))
        .withColumn(
            "next",
            F.expr(
                "CASE WHEN k % 10 = 2 AND page_seq = 1 THEN request_cursor "
                "WHEN k % 10 = 4 AND page_seq = 0 THEN NULL ELSE next END"
            ),
        )
        .withColumn("page_seq", F.when(F.col("empty") | late, F.col("page_seq") + 1).otherwise(F.col("page_seq")))
        .withColumn("listed", F.expr("""if(empty, '"comments":[]', listed)"""))
        .withColumn("request_cursor", F.expr("if(empty, 3L, request_cursor)"))
    )
    return _envelope(landed, "comments", run_id)


def profile_pages(spark: SparkSession, sf_dir: str, run_id: str = "r1") -> DataFrame:
    """A creator's videos, newest first, four to a page.

    Rows are numbered before they become text, and pages are made where their rows are, so that only the columns of
    the table are shuffled; the same holds for the comment and reply pages below.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    numbered = _numbered(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    rows = _video_texts(numbered, "o_custkey", "n", "total")
    pages = _pages(rows, ["client", "o_custkey"], 4, "aweme_list", "max_cursor")
    return _envelope(pages, "profile_videos", run_id)


def video_responses(spark: SparkSession, sf_dir: str, run_id: str = "r1") -> DataFrame:
    """One single-video response per order."""
    videos = raw_videos(spark, sf_dir).select(
        "client",
        F.col("k").cast("string").alias("video_id"),
        F.lit(0).alias("page_seq"),
        F.lit(0).cast("bigint").alias("request_cursor"),
        F.expr("""concat('{"aweme_detail":', body, '}')""").alias("body"),
        "fetched_at",
    )
    return _envelope(videos, "video", run_id)


# Lines 1-3 of an order are top-level here, the others answer one of them in turn.
THREAD_LINE = "(l_linenumber - 1) % 3 + 1"
THREAD_PARENT = f"if(l_linenumber <= 3, '0', concat(l_orderkey, '-', {THREAD_LINE}))"
THREAD_TOTAL = "if(l_linenumber > 3, 0, if(l_orderkey % 6 = 5, 0, 9))"


THREAD_JSON = comment_json(THREAD_PARENT, THREAD_TOTAL)


def thread_comment_pages(spark: SparkSession, sf_dir: str, run_id: str = "r1") -> DataFrame:
    """Top-level comment pages of two."""
    tops = _commented(spark, sf_dir).where("l_linenumber <= 3")
    rows = _numbered(tops, ["l_orderkey"], COMMENT_ORDER).select(
        F.col("l_orderkey").cast("string").alias("video_id"),
        F.col("l_orderkey").alias("k"),
        "client",
        "n",
        "total",
        F.expr(THREAD_JSON).alias("body"),
        S.from_utc_ntz(F.col("l_shipdate")).alias("fetched_at"),
    )
    return _envelope(
        _pages(rows, ["client", "video_id", "k"], 2, "comments", "cursor"), "comments", run_id
    )


def reply_pages(spark: SparkSession, sf_dir: str, run_id: str = "r1") -> DataFrame:
    """Reply pages of two per thread; every second order lists them under the other name."""
    replies = _commented(spark, sf_dir).where("l_linenumber > 3").withColumn(
        "line", F.expr(THREAD_LINE)
    )
    rows = _numbered(replies, ["l_orderkey", "line"], COMMENT_ORDER).select(
        F.col("l_orderkey").cast("string").alias("video_id"),
        F.expr("concat(l_orderkey, '-', line)").alias("parent_comment_id"),
        F.col("l_orderkey").alias("k"),
        "line",
        "client",
        "n",
        "total",
        F.expr(THREAD_JSON).alias("body"),
        S.from_utc_ntz(F.col("l_shipdate")).alias("fetched_at"),
    )
    pages = _pages(
        rows, ["client", "video_id", "parent_comment_id", "k", "line"], 2, "comments", "cursor"
    ).withColumn(
        "listed",
        F.expr(
            "if(bigint(video_id) % 2 = 1, "
            "concat('\"comments\":[],', replace(listed, '\"comments\":[', '\"replies\":[')), listed)"
        ),
    )
    return _envelope(pages, "replies", run_id)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per web page row, by page_id % 7, the page's text in its body."""
    error = (
        "CASE page_id % 3 WHEN 0 THEN to_json(named_struct('message', url)) "
        "WHEN 1 THEN to_json(named_struct('message', '', 'error', html)) "
        "ELSE concat('  <', html, ' ') END"
    )
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        F.col("page_id"),
        F.lit("r1").alias("run_id"),
        F.lit("comments").alias("endpoint"),
        F.lit("u0").alias("client"),
        F.expr("string(page_id)").alias("video_id"),
        F.lit(None).cast("string").alias("parent_comment_id"),
        F.lit(0).alias("page_seq"),
        F.lit(0).cast("bigint").alias("request_cursor"),
        F.expr(
            "int(element_at(array(200, 200, 200, 401, 402, 429, 503), int(page_id % 7) + 1))"
        ).alias("http_status"),
        F.expr(
            "CASE page_id % 7 WHEN 0 THEN to_json(named_struct('comments', "
            "array(named_struct('cid', string(page_id), 'text', html)), 'has_more', 0)) "
            f"WHEN 1 THEN ' \\n' WHEN 2 THEN concat('{{bad', html) ELSE {error} END"
        ).alias("body"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry lines, one per customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("client"),
        F.expr(
            "if(c_custkey % 10 = 0, '', concat('https://www.tiktok.com/@u', c_custkey, "
            "repeat('/', int(c_custkey % 3))))"
        ).alias("tiktok"),
        F.expr("concat('https://www.instagram.com/u', c_custkey)").alias("instagram"),
    )


def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every client name, every handle, and per order the name of a client nobody knows."""
    customers = table(spark, sf_dir, "customer")
    unknown = table(spark, sf_dir, "orders").select(
        F.expr("concat('nobody', o_orderkey)").alias("identifier")
    )
    return (
        customers.select(F.col("c_name").alias("identifier"))
        .unionByName(customers.select(F.expr("concat('u', c_custkey)").alias("identifier")))
        .unionByName(unknown)
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare ids, links and neither, by order key % 3."""
    return table(spark, sf_dir, "orders").select(
        F.expr(
            "CASE o_orderkey % 3 WHEN 0 THEN concat('\\t', o_orderkey, ' ') "
            "WHEN 1 THEN concat('https://t.example/@a/video/', o_orderkey, '?x=1') "
            "ELSE concat('no-id-', o_orderkey) END"
        ).alias("link"),
        F.expr("if(o_orderkey % 2 = 0, concat('u', o_custkey), null)").alias("owner"),
    )


def spoken_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as comments: the first one is top-level, the others answer it."""
    return table(spark, sf_dir, "conversations").select(
        F.expr("string(conv_id)").alias("video_id"),
        F.lit("talk").alias("client"),
        F.expr(
            "to_json(named_struct('cid', concat(conv_id, '/', turn), 'text', text, "
            "'user', named_struct('uid', role), "
            "'reply_id', if(turn = 0, '0', concat(conv_id, '/0'))))"
        ).alias("body"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )


def document_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as videos whose overlay is the whole text, stickers first and padded."""
    return table(spark, sf_dir, "documents").select(
        F.expr("concat('c', source)").alias("client"),
        F.expr(
            "to_json(named_struct('id', concat('d', doc_id), 'desc', text, "
            "'stickersOnItem', array(named_struct('stickerText', array('\\t', concat('\\u00a0', lang, ' ')))), "
            "'contents', array(named_struct('desc', concat('<', text, '>')))))"
        ).alias("body"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )
