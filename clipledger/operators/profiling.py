"""What raw JSON looks like, over a whole column of documents."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipledger.functions import scalars as S
from clipledger.functions import variants as V
from clipledger.session import scratch_dir
from clipledger.sources import files

# Where a profile response may keep its videos, and an item its id.
LIST_KEYS = ("aweme_list", "videos", "itemList", "data", "items")
VIDEO_ID_KEYS = ("aweme_id", "id", "video_id")


def _node(path: Column, value: Column, kind: Column, length: Column, is_open: Column) -> Column:
    return F.struct(
        path.alias("path"),
        value.alias("value"),
        kind.alias("type"),
        length.cast("int").alias("length"),
        is_open.alias("open"),
    )


def _expanded(path: Column, value: Column, max_keys: int | None) -> Column:
    """What one open node becomes: settled rows, and nodes to follow one level further."""
    nothing, no_value = F.lit(None), F.lit(None).cast("variant")
    yes, no = F.lit(True), F.lit(False)

    def member(entry: Column) -> Column:
        kind, size = V.kind_and_size(entry["value"])
        inner = F.when(path == "", entry["key"]).otherwise(
            F.concat(path, F.lit("."), entry["key"])
        )
        return _node(inner, entry["value"], kind, nothing, size > 0)

    members = F.map_entries(V.fields(value))
    cut = _node(F.concat(path, F.lit(".…")), no_value, F.lit("more keys"), nothing, no)
    if max_keys is None:
        of_dict = F.transform(members, member)
    else:
        of_dict = F.concat(
            F.transform(F.slice(members, 1, max_keys), member),
            F.filter(F.array(cut), lambda _: F.size(members) > max_keys),
        )

    listed = V.elements(value)
    itself = _node(path, no_value, F.lit("list"), F.size(listed), no)
    first = _node(
        F.concat(path, F.lit("[0]")), F.get(listed, F.lit(0)), F.lit("item"), nothing, yes
    )
    of_list = F.when(F.size(listed) > 0, F.array(itself, first)).when(
        listed.isNotNull(), F.array(itself)
    )
    # Objects and lists are settled above; what reaches this has a name that needs no walk.
    of_scalar = F.array(_node(path, no_value, V.type_name(value), nothing, no))
    return F.coalesce(of_dict, of_list, of_scalar)


#: Levels that one pass over open nodes follows.
LEVELS = 6


@lru_cache(maxsize=8)
def _grown(spark: SparkSession, max_keys: int | None) -> Column:
    """What any node becomes, one level further. Made once a session: PySpark numbers the variables of lambdas throughout a process,
    and plans would differ by these names with every level and call."""
    node = F.col("node")
    return F.when(node["open"], _expanded(node["path"], node["value"], max_keys)).otherwise(F.array(node))


def _followed(nodes: DataFrame, levels: int, max_keys: int | None) -> DataFrame:
    """Nodes some levels further; each level is one explode, and nothing is shuffled."""
    grown = _grown(nodes.sparkSession, max_keys)
    for _ in range(levels):
        nodes = nodes.select(F.explode(grown).alias("node"))
    return nodes


def _rows(nodes: DataFrame) -> DataFrame:
    node = F.col("node")
    kind = F.when(node["open"], "...").otherwise(node["type"])
    return nodes.select(
        node["path"].alias("path"), kind.alias("type"), node["length"].alias("length")
    )


def _stored(nodes: DataFrame, path: str) -> None:
    """Settled rows and open nodes, in a folder each, by one walk."""
    node = F.col("node")
    nodes.select(
        node["path"].alias("path"),
        F.when(node["open"], node["value"]).alias("value"),
        node["type"].alias("type"),
        node["length"].alias("length"),
        node["open"].alias("open"),
    ).write.partitionBy("open").parquet(path)


def _deeper(frontier: DataFrame, max_keys: int | None) -> DataFrame:
    """Rows of everything below open nodes, whatever their depth.

    Each round follows the open nodes of the one before ``LEVELS`` further, and stores settled rows and open nodes; the plan
    of a round, and that of the result, is the same for any depth.
    """
    spark = frontier.sparkSession
    base = scratch_dir(spark, "paths")
    stored = "path string, value variant, type string, length int"
    _stored(frontier, f"{base}/round=0")
    turn = 0
    while files.has_data(spark, f"{base}/round={turn}/open=true"):
        nodes = spark.read.schema(stored).parquet(f"{base}/round={turn}/open=true")
        no = F.lit(None)
        opened = nodes.select(_node(F.col("path"), F.col("value"), no, no, F.lit(True)).alias("node"))
        _stored(_followed(opened, LEVELS, max_keys), f"{base}/round={turn + 1}")
        files.remove(spark, f"{base}/round={turn}/open=true")
        turn += 1
    settled = spark.read.schema("path string, type string, length int").option("recursiveFileLookup", True)
    return settled.parquet(base)


def json_paths(
    documents: DataFrame,
    column: str = "raw",
    max_depth: int | None = None,
    max_keys: int | None = None,
) -> DataFrame:
    """One row per path of each document: path, type, and the length of lists.

    Objects are followed key by key, lists into their first element. Given ``max_keys``, only so
    many keys by name are followed; given ``max_depth``, anything deeper is "...". Otherwise the first ``LEVELS`` levels
    come straight from the documents, and what is still open below them is stored and followed on, so that a deep
    document costs rounds over its own open nodes and nothing for all others.
    """
    root = _node(F.lit(""), F.col(column), F.lit("root"), F.lit(None), F.lit(True))
    nodes = documents.where(F.col(column).isNotNull()).select(root.alias("node"))
    if max_depth is not None:
        return _rows(_followed(nodes, max_depth + 1, max_keys))
    near = _followed(nodes, LEVELS + 1, max_keys)
    settled = _rows(near.where(~F.col("node.open")))
    return settled.unionByName(_deeper(near.where(F.col("node.open")), max_keys))


def json_shape_profile(
    documents: DataFrame,
    column: str = "raw",
    max_depth: int | None = None,
    max_keys: int | None = None,
) -> DataFrame:
    """How often each path has each type, and the mean length of its lists."""
    return (
        json_paths(documents, column, max_depth, max_keys)
        .groupBy("path", "type")
        .agg(F.count("*").alias("documents"), F.avg("length").alias("mean_length"))
    )


def first_video_link(responses: DataFrame, column: str, handle: Column) -> DataFrame:
    """Adds ``first_video_url``: the first identifiable video of each profile response.

    The first key that holds a list decides, even when that list is empty.
    """
    raw = F.col(column)
    candidates = F.coalesce(*[V.elements(V.at(raw, key)) for key in LIST_KEYS])
    ids = F.transform(
        candidates,
        lambda item: V.to_text(V.first_truthy(*[V.at(item, key) for key in VIDEO_ID_KEYS])),
    )
    found = F.get(F.filter(ids, lambda video_id: video_id.isNotNull()), F.lit(0))
    return responses.withColumn(
        "first_video_url", F.concat(F.lit(S.SITE), handle, F.lit("/video/"), found)
    )
