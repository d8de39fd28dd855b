"""How far each paginated request has been read: state that lets a batch open new pages only.

Under a state folder, every table has a folder per batch, and a batch reads those before its own, so a
replay starts from what the first try started from:

* ``pages``    - landed pages as staged; opened once, when they count, and dropped when nothing waits in their batch;
* ``failed``   - failed responses and broken lines, without bodies;
* ``turns``    - the crawls and creators a batch touched;
* ``unread``   - paging fields of landed pages that don't count yet: a page before them is missing, or nobody asked for
  their video or thread so far. Each turn of a crawl replaces the one before;
* ``frontier`` - last page read of a request, and whether the request has ended;
* ``seen``     - ids that occurred; ``counts`` - how many items did, for bounds;
* ``targets``, ``threads`` - videos whose comments, and comments whose replies, are wanted.

All but ``pages`` hold a few short columns and are stored by crawl.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipledger.functions import variants as V
from clipledger.operators import paging as P
from clipledger.operators.parsing import parse_comments, parse_videos
from clipledger.operators.replies import ORDER, VIDEO_REQUEST, top_level
from clipledger.operators.routing import OK
from clipledger.plans import collect as C
from clipledger.session import scratch_dir
from clipledger.sources import files
from clipledger.sources.contracts import COMMENTS, PROFILE_VIDEOS, REPLIES, REQUEST, VIDEO_ENDPOINT

# Up to this many touched crawls, or batches with waiting pages, are named in a scan, which prunes the folders of
# all others. With more, the join alone selects them, with the same result.
NAMED = 1000

_CRAWL = ("run_id", "client")
_THREAD = (*VIDEO_REQUEST, "parent_comment_id")
_SLIM = ("page_seq", "n_items", "has_more", "next_cursor", "request_cursor")


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_TEXT, _LONG, _INT, _FLAG = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
_REQUEST = {name: _TEXT for name in REQUEST}
SCHEMAS = {
    "turns": _fields(run_id=_TEXT, client=_TEXT),
    "unread": _fields(
        **_REQUEST, page_seq=_INT, n_items=_INT, has_more=_FLAG, next_cursor=_TEXT, request_cursor=_LONG, landed=_LONG
    ),
    "frontier": _fields(**_REQUEST, last_page=_INT, ended=_FLAG),
    "seen": _fields(run_id=_TEXT, client=_TEXT, video_id=_TEXT, kind=_TEXT, key=_TEXT),
    "counts": _fields(run_id=_TEXT, client=_TEXT, video_id=_TEXT, parent_comment_id=_TEXT, kind=_TEXT, n=_LONG),
    "targets": _fields(run_id=_TEXT, client=_TEXT, video_id=_TEXT, parsed_id=_TEXT),
    "threads": _fields(run_id=_TEXT, client=_TEXT, video_id=_TEXT, parent_comment_id=_TEXT, top_ord=_LONG),
}


class State:
    """What earlier batches left of the crawls that this one touches."""

    def __init__(self, spark: SparkSession, root: str, batch_id: int):
        self.spark, self.root, self.batch_id = spark, root, batch_id
        staged = self.pages([batch_id])
        self.write("turns", staged.select(*_CRAWL).distinct())
        self.touched = self._table("turns").where(F.col("batch") == batch_id).drop("batch")
        runs = self.touched.select("run_id").distinct().limit(NAMED + 1).collect()
        self.runs = [row.run_id for row in runs] if len(runs) <= NAMED else None

    def _table(self, name: str) -> DataFrame:
        stored = T.StructType([*SCHEMAS[name], T.StructField("batch", _LONG)])
        if not files.matches(self.spark, f"{self.root}/{name}/batch=*"):
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(f"{self.root}/{name}")

    def pages(self, batches: Sequence[int] | None) -> DataFrame:
        """Staged pages of some batches, or of all up to this one."""
        schema = T.StructType([*C.STAGED_SCHEMA, T.StructField("batch", _LONG)])
        found = self.spark.read.schema(schema).parquet(f"{self.root}/pages")
        if batches is None:
            return found.where(F.col("batch") <= self.batch_id)
        return found.where(F.col("batch").isin(list(batches)))

    def _of_these_runs(self, found: DataFrame) -> DataFrame:
        return found if self.runs is None else found.where(F.col("run_id").isin(self.runs))

    def read(self, name: str) -> DataFrame:
        """Rows of earlier batches, of the touched crawls and creators."""
        found = self._of_these_runs(self._table(name).where(F.col("batch") < self.batch_id))
        return found.join(self.touched, list(_CRAWL), "left_semi")

    def unread(self) -> DataFrame:
        latest = self.read("turns").groupBy(*_CRAWL).agg(F.max("batch").alias("batch"))
        return self.read("unread").join(latest, [*_CRAWL, "batch"], "left_semi").drop("batch")

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        """Store this batch's rows of a table; returns them as stored."""
        path = f"{self.root}/{name}/batch={self.batch_id}"
        by = ["run_id"] if name != "turns" else []
        rows.select(SCHEMAS[name].fieldNames()).write.mode("overwrite").partitionBy(*by).parquet(path)
        return self.spark.read.schema(SCHEMAS[name]).parquet(path)

    def drop_read_pages(self) -> None:
        """Remove pages in which nothing waits any more, and lists of waiting pages that later turns replaced.

        Earlier batches are over for good when this one begins, so none of them is tried again.
        """
        turns = self._table("turns").where(F.col("batch") < self.batch_id)
        latest = turns.groupBy(*_CRAWL).agg(F.max("batch").alias("batch"))
        waiting = self._table("unread").join(latest, [*_CRAWL, "batch"], "left_semi")
        kept = {  # numbers of batches
            "pages": {row.landed for row in waiting.select("landed").distinct().collect()},
            "unread": {row.batch for row in latest.select("batch").distinct().collect()},
        }
        for name, numbers in kept.items():
            for path in files.matches(self.spark, f"{self.root}/{name}/batch=*"):
                number = int(path.rsplit("=", 1)[1])
                if number < self.batch_id and number not in numbers:
                    files.remove(self.spark, path)


def _reach(fresh: DataFrame) -> DataFrame:
    """How far each request gets with its pages behind the frontier.

    The rules are those of ``page_stitch`` with ``contiguous``, starting at the frontier instead of the first page.
    """
    place = F.dense_rank().over(Window.partitionBy(*REQUEST).orderBy("page_seq"))
    ends = ~F.col("has_more") | F.coalesce(
        F.col("next_cursor") == F.col("request_cursor").cast("string"), F.lit(True)
    )
    stop = F.when(F.col("n_items") == 0, F.col("page_seq") - 1).when(ends, F.col("page_seq"))
    return (
        fresh.withColumn("_place", place)
        .where(F.col("page_seq") == F.col("last_page") + F.col("_place"))
        .groupBy(*REQUEST)
        .agg(F.max("page_seq").alias("far"), F.min(stop).alias("stop"))
        .select(*REQUEST, F.least("far", "stop").alias("last_page"), F.col("stop").isNotNull().alias("ended"))
    )


class Batch:
    """One batch's way through the families: each step stores what it read before the next one asks for it."""

    def __init__(self, state: State):
        self.state, self.spark = state, state.spark
        self.scratch = scratch_dir(state.spark, "advance")
        new = state.pages([state.batch_id]).where(F.col("route") == OK)
        new = new.select(*REQUEST, *_SLIM, F.lit(state.batch_id).cast("bigint").alias("landed"))
        self.slim = self._keep("slim", new.unionByName(state.unread()))
        latest = F.max_by(F.struct("last_page", "ended"), "batch").alias("now")
        self.frontier = state.read("frontier").groupBy(*REQUEST).agg(latest).select(*REQUEST, "now.*")
        self.reached: list[DataFrame] = []
        self.left: list[DataFrame] = []
        self.seen_now: list[DataFrame] = []
        self.counted: list[DataFrame] = []

    def _keep(self, name: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{self.scratch}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.scratch}/{name}")

    def items(self, endpoint: str, wanted: DataFrame | None, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
        """Items of the pages that count from now on, of requests that ``wanted`` names by ``keys``.

        What the pages are joined with is stored with them, as they are asked three times: how far requests get, what counts, what waits.
        """
        pages = self.slim.where(F.col("endpoint") == endpoint)
        if wanted is not None:
            named = wanted.select(*keys).distinct().withColumn("asked", F.lit(True))
            pages = pages.join(named, list(keys), "left")
        else:
            pages = pages.withColumn("asked", F.lit(True))
        known = pages.join(self.frontier.where(F.col("endpoint") == endpoint), list(REQUEST), "left")
        known = self._keep(f"known_{endpoint}", known.withColumn("last_page", F.coalesce("last_page", F.lit(-1))))
        if wanted is not None:
            self.left.append(known.where("asked is null").select(*self.slim.columns))
        behind = (F.col("page_seq") > F.col("last_page")) & ~F.coalesce("ended", F.lit(False))
        fresh = known.where(F.col("asked") & behind)
        reach = self._keep(f"reach_{endpoint}", _reach(fresh))
        self.reached.append(reach)
        placed = self._keep(f"placed_{endpoint}", fresh.drop("asked", "last_page", "ended").join(reach, list(REQUEST), "left"))
        waits = F.coalesce(F.col("page_seq") > F.col("last_page"), F.lit(True)) & ~F.coalesce("ended", F.lit(False))
        self.left.append(placed.where(waits).select(*self.slim.columns))
        ready = placed.where(F.col("page_seq") <= F.col("last_page")).select(*REQUEST, "page_seq", "landed")
        return P.page_items(self._opened(ready, endpoint), extra)

    def _opened(self, ready: DataFrame, endpoint: str) -> DataFrame:
        landed = [row.landed for row in ready.select("landed").distinct().limit(NAMED + 1).collect()]
        pages = self.state.pages(landed if len(landed) <= NAMED else None)
        pages = self.state._of_these_runs(pages.where((F.col("endpoint") == endpoint) & (F.col("route") == OK)))
        return pages.withColumnRenamed("batch", "landed").join(ready, [*REQUEST, "page_seq", "landed"], "left_semi")

    def first(self, items: DataFrame, kind: str, id_keys: tuple[str, str], scope: Sequence[str], order: Sequence[str]) -> DataFrame:
        """Items whose id occurred neither in an earlier batch nor before them in this one; their ids are remembered."""
        key = F.to_json(P.item_id(F.col("item"), id_keys))
        before = self.state.read("seen").where(F.col("kind") == kind).select(*scope, F.col("key").alias("_key"))
        new = P.first_keyed(items, id_keys, scope, order).join(before, [*scope, "_key"], "left_anti")
        new = self._keep(f"first_{kind}", new.drop("_key").withColumn("key", key))
        video = F.col("video_id") if "video_id" in scope else F.lit("")
        self.seen_now.append(
            new.where("key is not null").select(*_CRAWL, video.alias("video_id"), F.lit(kind).alias("kind"), "key")
        )
        return new.drop("key")

    def bounded(self, items: DataFrame, kind: str, count: int | None, scope: Sequence[str], order: Sequence[str]) -> DataFrame:
        """The first ``count`` items of each scope, those of earlier batches included in the count."""
        if count is None:
            return items
        named = ["run_id", "client", "video_id", "parent_comment_id"]
        full = [F.col(name) if name in scope else F.lit("").alias(name) for name in named]
        self.counted.append(items.groupBy(*scope).agg(F.count("*").alias("n")).select(*full, F.lit(kind).alias("kind"), "n"))
        before = self.state.read("counts").where(F.col("kind") == kind).groupBy(*scope).agg(F.sum("n").alias("_before"))
        kept = P.bounded_take(items, count, scope, order)
        rank = F.row_number().over(Window.partitionBy(*scope).orderBy(*order))
        within = F.col("_rank") + F.coalesce("_before", F.lit(0)) <= count
        return kept.withColumn("_rank", rank).join(before, list(scope), "left").where(within).drop("_rank", "_before")

    def known(self, name: str, new: DataFrame) -> DataFrame:
        """Rows of a table from earlier batches and from this one."""
        return self.state.read(name).drop("batch").unionByName(self.state.write(name, new))

    def finish(self) -> None:
        """Store what the next batch starts from."""
        def all_of(name: str, parts: list[DataFrame]) -> DataFrame:
            if not parts:
                return self.spark.createDataFrame([], SCHEMAS[name])
            return reduce(DataFrame.unionByName, [part.select(SCHEMAS[name].fieldNames()) for part in parts])

        self.state.write("seen", all_of("seen", self.seen_now))
        self.state.write("counts", all_of("counts", self.counted))
        self.state.write("frontier", all_of("frontier", self.reached))
        self.state.write("unread", all_of("unread", self.left))
        files.remove(self.spark, self.scratch)


def advance(
    spark: SparkSession,
    root: str,
    batch_id: int,
    store_videos: Callable[[DataFrame], object],
    store_comments: Callable[[DataFrame], object],
    max_videos: int | None = None,
    comment_count: int | None = None,
    include_replies: bool = False,
    max_replies: int | None = None,
) -> None:
    """Hand over the videos and comments that count since batch ``batch_id`` has landed, then note how far that got.

    Every page is opened once, in the batch in which it comes to count. Taken together, batches give what ``ingest_sweep``
    and ``ingest_video`` give for all of their pages; ids that occur both in a thread and elsewhere belong to whichever counted first.
    """
    state = State(spark, root, batch_id)
    state.drop_read_pages()
    batch = Batch(state)

    swept = batch.items(PROFILE_VIDEOS.endpoint, None, ())
    swept = batch.first(swept, "profile", PROFILE_VIDEOS.id_keys, _CRAWL, ("ord",))
    swept = batch.bounded(swept, "profile", max_videos, _CRAWL, ("ord",))
    videos = parse_videos(swept, keep=("run_id", "ord")).withColumn("requested_id", F.col("video_id"))
    staged = state.pages([batch_id])
    videos = batch._keep("videos", videos.unionByName(C.requested_videos(staged), allowMissingColumns=True))
    store_videos(videos)
    asked = videos.groupBy(*_CRAWL, F.col("requested_id").alias("video_id")).agg(F.min("video_id").alias("parsed_id"))
    targets = batch.known("targets", asked)

    tops = batch.items(COMMENTS.endpoint, targets, VIDEO_REQUEST)
    tops = batch.first(tops, "top", COMMENTS.id_keys, VIDEO_REQUEST, ("ord",))
    tops = top_level(batch.bounded(tops, "top", comment_count, VIDEO_REQUEST, ("ord",)))
    if include_replies:
        tops = batch._keep("tops", tops)
        collected = _with_replies(batch, tops, max_replies)
    else:
        collected = tops
    renamed = C.under_parsed_ids(collected, targets)
    store_comments(parse_comments(renamed, keep=("run_id", *ORDER)))

    failed = C.failed_responses(staged)
    failed.write.mode("overwrite").parquet(f"{root}/failed/batch={batch_id}")
    batch.finish()


def _with_replies(batch: Batch, tops: DataFrame, max_replies: int | None) -> DataFrame:
    """Top-level comments of this batch, and the replies that count now, also those of earlier comments."""
    own_id = P.item_id(F.col("item"), COMMENTS.id_keys)
    total = V.to_int(V.at(F.col("item"), "reply_comment_total"))
    opened = tops.where(V.truthy(own_id) & (total > 0)).select(
        *VIDEO_REQUEST, V.to_text(own_id).alias("parent_comment_id"), "top_ord"
    )
    threads = batch.known("threads", opened).groupBy(*_THREAD).agg(F.min("top_ord").alias("top_ord"))
    replies = batch.items(REPLIES.endpoint, threads, _THREAD).join(threads, list(_THREAD))
    replies = replies.select(
        *VIDEO_REQUEST,
        F.col("parent_comment_id").alias("thread_id"),
        "fetched_at",
        "item",
        "top_ord",
        F.lit(1).alias("is_reply"),
        "ord",
    )
    new = batch.first(tops.unionByName(replies), "all", COMMENTS.id_keys, VIDEO_REQUEST, ORDER)
    kept = batch.bounded(
        new.where("is_reply = 1").withColumn("parent_comment_id", F.col("thread_id")), "reply", max_replies, _THREAD, ORDER
    )
    return new.where("is_reply = 0").unionByName(kept.drop("parent_comment_id"))
