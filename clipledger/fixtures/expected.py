"""Expected results as SQL over the base tables.

Every statement works from keys and columns of the test tables with CASE; none of them builds or
reads JSON, so they share no code path with the jobs they check.
"""

from __future__ import annotations

# -- videos ---------------------------------------------------------------------------------
# One row per order, as parsing should return it; ``landed`` is false for items without id.
VIDEOS = """
videos AS (
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderdate AS day, o_orderkey % 97 <> 0 AS landed,
    CAST(o_orderkey AS VARCHAR) AS video_id,
    'u' || o_custkey AS client,
    'https://www.tiktok.com/@' || CASE WHEN o_orderkey % 4 IN (0, 1) THEN 'h' ELSE 'u' END
      || o_custkey || '/video/' || o_orderkey AS url,
    CASE WHEN o_orderkey % 20 IN (2, 3) AND o_orderkey % 4 IN (2, 3) THEN NULL
      ELSE o_orderdate END AS created_at,
    CASE o_orderkey % 4 WHEN 2 THEN NULL WHEN 3 THEN '' ELSE o_orderpriority END AS caption,
    CASE o_orderkey % 4 WHEN 0 THEN 'hi' WHEN 1 THEN 'l1' WHEN 2 THEN NULL
      ELSE 's' || chr(10) || 'c' END AS overlay_text,
    CAST(NULL AS VARCHAR) AS transcript,
    CASE o_orderkey % 4 WHEN 0 THEN 'p' || (o_orderkey % 3) WHEN 1 THEN 'a,b,c' ELSE '' END
      AS hashtags,
    CASE o_orderkey % 4 WHEN 0 THEN 'm' || (o_orderkey % 5) WHEN 1 THEN 'n' || (o_orderkey % 5)
      END AS music,
    CAST(CASE o_orderkey % 4 WHEN 2 THEN NULL WHEN 3 THEN 12 ELSE o_orderkey % 60 END AS BIGINT)
      AS duration_s,
    CAST(CASE o_orderkey % 4 WHEN 2 THEN NULL WHEN 3 THEN o_orderkey
      ELSE floor(o_totalprice) END AS BIGINT) AS like_count,
    CAST(CASE o_orderkey % 4 WHEN 2 THEN 12 WHEN 3 THEN NULL ELSE o_orderkey % 20 END AS BIGINT)
      AS comment_count,
    CAST(CASE o_orderkey % 4 WHEN 2 THEN NULL WHEN 3 THEN 0 ELSE o_orderkey % 7 END AS BIGINT)
      AS share_count,
    CAST(CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 100 * o_orderkey WHEN 2 THEN 1
      ELSE 7 END AS BIGINT) AS play_count,
    o_orderdate AS collected_at
  FROM orders)"""

VIDEO_COLUMNS = (
    "video_id, client, url, created_at, caption, overlay_text, transcript, hashtags, music, "
    "duration_s, like_count, comment_count, share_count, play_count, collected_at"
)

# -- comments -------------------------------------------------------------------------------
COMMENTS = """
comments_in AS (
  SELECT l_orderkey AS k, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
    l_shipdate AS shipped, l_partkey % 101 <> 0 AS landed,
    l_orderkey || '-' || l_linenumber AS comment_id,
    CAST(l_orderkey AS VARCHAR) AS video_id,
    'u' || o_custkey AS client,
    l_returnflag || ' "' || l_linestatus || '" ' || chr(10) || l_partkey AS text,
    CAST(l_quantity AS BIGINT) AS like_count,
    CAST(NULL AS BIGINT) AS reply_count,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE l_orderkey || '-1' END AS parent_comment_id,
    CASE WHEN l_suppkey % 7 = 0 AND l_suppkey % 5 <> 0 THEN NULL
      ELSE sha256('s' || l_suppkey) END AS author_hash,
    l_shipdate AS created_at,
    l_shipdate AS collected_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

COMMENT_COLUMNS = (
    "comment_id, video_id, client, text, like_count, reply_count, parent_comment_id, "
    "author_hash, created_at, collected_at"
)

# Newest line per comment id.
LATEST = """
comments_now AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY client, comment_id
      ORDER BY shipped DESC, part DESC, supp DESC) AS place
    FROM comments_in WHERE landed)
  WHERE place = 1)"""

# -- paging ---------------------------------------------------------------------------------
# Lines numbered within their order; the misbehaving pages end some requests early.
PAGED = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY shipped, line, part, supp) - 1 AS n
  FROM comments_in),
paged AS (
  SELECT *, CAST(n // 3 AS BIGINT) AS page_seq FROM numbered
  WHERE n < CASE k % 10 WHEN 1 THEN 6 WHEN 2 THEN 6 WHEN 3 THEN 3 WHEN 4 THEN 3
    ELSE 1000000000 END)"""

SEEN = """
seen AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY k, landed, line ORDER BY n) AS copy FROM paged)
  WHERE NOT landed OR copy = 1)"""

TAKEN = """
taken AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n) AS place FROM seen)
  WHERE place <= {count})"""

# -- threads --------------------------------------------------------------------------------
# Lines 1-3 are top-level, later ones answer them in turn; bounds are applied per video and thread.
THREADS = """
threaded AS (
  SELECT *, (line - 1) % 3 + 1 AS thread, line <= 3 AS is_top,
    CAST(CASE WHEN line > 3 THEN 0 WHEN k % 6 = 5 THEN 0 ELSE 9 END AS BIGINT) AS reply_total,
    row_number() OVER (PARTITION BY k, landed, line ORDER BY shipped, part, supp) AS copy
  FROM comments_in),
tops AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY shipped, line, part, supp) AS place
    FROM threaded WHERE is_top AND (copy = 1 OR NOT landed))
  WHERE place <= {tops}),
replies_kept AS (
  SELECT r.* FROM (
    SELECT *, row_number() OVER (PARTITION BY k, thread ORDER BY shipped, line, part, supp) AS place
    FROM threaded WHERE NOT is_top AND (copy = 1 OR NOT landed)) r
  JOIN (SELECT DISTINCT k, line FROM tops WHERE landed AND reply_total > 0) t
    ON r.k = t.k AND r.thread = t.line
  WHERE r.place <= {replies}),
thread_items AS (
  SELECT *, 0 AS is_reply, CAST(NULL AS VARCHAR) AS parent FROM tops
  UNION ALL
  SELECT *, 1 AS is_reply, k || '-' || thread AS parent FROM replies_kept)"""


def with_parts(*parts: str) -> str:
    return "WITH " + ",".join(parts)
