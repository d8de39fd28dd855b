import json
import re

from pyspark.sql import functions as F

from clipledger.functions import variants as V
from clipledger.operators.profiling import first_video_link, json_paths, json_shape_profile


def paths(spark, *documents, **bounds):
    rows = spark.createDataFrame([(json.dumps(one),) for one in documents], "text string")
    found = json_paths(rows.select(F.parse_json("text").alias("raw")), **bounds).collect()
    return sorted((row.path, row.type, row.length) for row in found)


def test_paths(spark):
    document = {
        "a": 1, "b": {"c": "x", "d": {}}, "e": [], "f": [{"g": None}, {"h": 1}], "i": [[1, 2], 3],
        "n": {"o": {"p": {"q": {"r": {"s": 1}, "t": []}}}},
    }
    assert paths(spark, document, max_depth=4) == [
        ("a", "int", None), ("b.c", "str", None), ("b.d", "dict", None), ("e", "list", None),
        ("f", "list", 2), ("f[0].g", "null", None), ("i", "list", 2), ("i[0]", "list", 2),
        ("i[0][0]", "int", None), ("n.o.p.q.r", "...", None), ("n.o.p.q.t", "list", None),
    ]


def test_roots_and_wide_objects(spark):
    assert paths(spark, [], {}, 5, "x", [{}], [[]]) == [
        ("", "int", None), ("", "list", 0), ("", "list", 1), ("", "list", 1), ("", "str", None),
        ("[0]", "list", 0),
    ]
    wide = paths(spark, {f"k{n:02d}": n for n in range(45)}, max_keys=40)
    assert len(wide) == 41 and wide[0] == (".…", "more keys", None)
    assert [path for path, _, _ in wide[1:]] == [f"k{n:02d}" for n in range(40)]


def test_nothing_is_left_out_by_default(spark):
    wide = paths(spark, {f"k{n:03d}": n for n in range(100)})
    assert [path for path, _, _ in wide] == [f"k{n:03d}" for n in range(100)]
    deep = 1
    for n in reversed(range(12)):
        deep = {f"d{n}": deep, 'a"{[': "}]{{{{[[["}
    found = paths(spark, deep, {"x": [[[{"y": 1}]]]})
    assert (".".join(f"d{n}" for n in range(12)), "int", None) in found
    assert ("x[0][0][0].y", "int", None) in found and all(kind != "..." for _, kind, _ in found)


def nested(depth):
    value = 1
    for _ in range(depth):
        value = {"k": value}
    return value


def test_plan_is_the_same_for_any_depth(spark):
    plans = []
    for depth in (6, 60, 300):
        text = spark.createDataFrame([(json.dumps(nested(depth)),), ('{"a":[1]}',)], "text string")
        found = json_paths(text.select(F.parse_json("text").alias("raw")))
        plans.append(re.sub(r"#\d+", "", found._jdf.queryExecution().optimizedPlan().toString()))
        assert sorted(tuple(row) for row in found.collect()) == [
            ("a", "list", 1), ("a[0]", "int", None), (".".join("k" * depth), "int", None),
        ]
    assert len(set(plans)) == 1


def test_every_depth_around_a_round(spark):
    documents = [nested(depth) for depth in range(12)] + [[[[[[[[["x"]]]]]]]]]
    found = paths(spark, *documents)
    assert [row for row in found if row[1] == "int"] == sorted((".".join("k" * d), "int", None) for d in range(12))
    assert ("[0]" * 8, "str", None) in found and len([row for row in found if row[1] == "list"]) == 8


def test_profile(spark):
    rows = spark.createDataFrame([('{"a":[1,2]}',), ('{"a":[1]}',), ('{"a":5}',)], "text string")
    profile = json_shape_profile(rows.select(F.parse_json("text").alias("raw"))).collect()
    assert {(row.path, row.type): (row.documents, row.mean_length) for row in profile} == {
        ("a", "list"): (2, 1.5), ("a[0]", "int"): (2, None), ("a", "int"): (1, None),
    }


def test_first_video_link(spark):
    cases = [
        ('{"aweme_list":[{"id":0},5,{"aweme_id":"","video_id":"9"}]}', "9"),
        ('{"aweme_list":[],"videos":[{"id":1}]}', None),
        ('{"aweme_list":null,"data":{"id":1},"items":[{"id":2}]}', "2"),
        ("{}", None), ("[1]", None), ('{"itemList":[{"aweme_id":3,"id":4}]}', "3"),
    ]
    rows = spark.createDataFrame([(n, text) for n, (text, _) in enumerate(cases)], "n int, text string")
    raw = rows.select("n", F.parse_json("text").alias("raw"))
    found = first_video_link(raw, "raw", F.lit("me")).orderBy("n").collect()
    assert [row.first_video_url for row in found] == [
        wanted and f"https://www.tiktok.com/@me/video/{wanted}" for _, wanted in cases
    ]


def test_following_walks_no_subtree_for_its_type(spark):
    """Each level asks for the entries of a node, not for the text or type of all that lies below it."""
    values = ["null", "true", "0", "1.5", '""', '"x"', "{}", "[]", '{"a":{}}', "[[]]", "12345678901234567890"]
    rows = spark.createDataFrame([(text,) for text in values], "text string").select(F.parse_json("text").alias("raw"))
    kind, size = V.kind_and_size(F.col("raw"))
    follow = V.type_name(F.col("raw")).isin("dict", "list") & V.truthy(F.col("raw"))
    for row in rows.select(kind.alias("kind"), V.type_name(F.col("raw")).alias("name"), (size > 0).alias("open"), follow.alias("follow")).collect():
        assert (row.kind, row.open) == (row.name, row.follow)
    plan = json_paths(rows, max_depth=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan
