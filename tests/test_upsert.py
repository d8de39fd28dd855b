"""Newest-wins merge: hand-written cases and properties against a plain loop."""

import random

import pytest

from pyspark.sql import functions as F

from clipledger.operators.upsert import upsert_latest, with_arrival

SCHEMA = "client string, id string, collected_at long, value int, ord int"


def merge_by_hand(existing, incoming):
    """Later rows replace earlier ones of the same key unless they are older."""
    best = {}
    for row in [*existing, *incoming]:
        key, time = row[:2], float("inf") if row[2] is None else row[2]
        if key not in best or time >= best[key][0]:
            best[key] = (time, row)
    return {row for _, row in best.values()}


def merged(spark, existing, incoming):
    old = spark.createDataFrame(existing, SCHEMA)
    new = spark.createDataFrame(incoming, SCHEMA)
    return {tuple(row) for row in upsert_latest(old, new, "id", order=("ord",)).collect()}


def test_ties_nulls_and_null_keys(spark):
    existing = [("c", "a", 1, 1, 0), ("c", "b", 5, 1, 0), ("c", "n", None, 1, 0), ("c", None, 1, 1, 0)]
    incoming = [("c", "a", 1, 2, 0), ("c", "b", 4, 2, 1), ("c", "n", 9, 2, 2), ("c", None, 1, 2, 3)]
    assert merged(spark, existing, incoming) == {
        ("c", "a", 1, 2, 0), ("c", "b", 5, 1, 0), ("c", "n", None, 1, 0), ("c", None, 1, 2, 3),
    }


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_arrival_settles_ties(spark, tmp_path_factory, parts):
    """No order column: the row that stands later in the files wins, however rows are read and dealt."""
    folder = tmp_path_factory.mktemp("arrival")
    rng, rows = random.Random(3), []
    for number in range(5):
        some = [(rng.randrange(40), len(rows) + k) for k in range(300)]
        rows += some
        (folder / f"part-{number}.json").write_text("\n".join(f'{{"id":"k{key}","value":{v}}}' for key, v in some))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700" if parts == 64 else before)
    try:
        read = spark.read.schema("id string, value int").json(str(folder))
        arrived = with_arrival(read).withColumn("client", F.lit("c")).withColumn("collected_at", F.lit(1))
        found = upsert_latest(None, arrived.repartition(parts), "id")
        assert found.columns == ["id", "value", "client", "collected_at"]
        assert {(row.id, row.value) for row in found.collect()} == set({f"k{key}": v for key, v in rows}.items())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_inputs(spark):
    assert merged(spark, [], []) == set()
    assert merged(spark, [("c", "a", 1, 1, 0)], []) == {("c", "a", 1, 1, 0)}


def test_without_time_the_last_row_wins(spark):
    new = spark.createDataFrame([("c", "a", 1, 1), ("c", "a", 2, 0)], "client string, id string, value int, ord int")
    assert [row.value for row in upsert_latest(None, new, "id", order=("ord",)).collect()] == [1]


@pytest.mark.parametrize("seed", range(3))
def test_properties(spark, seed):
    rnd = random.Random(seed)

    def rows(count, start):
        return [
            (rnd.choice("xy"), rnd.choice(["a", "b", "c", "d", None]),
             rnd.choice([None, 1, 2, 3]), start + n, n)
            for n in range(count)
        ]

    # A stored table has one row per key already.
    existing = sorted(merge_by_hand([], rows(20, 0)), key=str)
    incoming = rows(30, 100)
    result = merged(spark, existing, incoming)
    assert result == merge_by_hand(existing, incoming)
    assert len({row[:2] for row in result}) == len(result)
    assert merged(spark, sorted(result, key=str), incoming) == result
    shuffled = incoming[:]
    rnd.shuffle(shuffled)
    assert merged(spark, existing, shuffled) == result


def test_hot_key(spark):
    """A third of all rows are copies of one key; each task sends on one of them at most."""
    rows = spark.range(300_000).selectExpr(
        "'c' AS client", "string(if(id % 3 = 0, 0, id)) AS id", "id AS collected_at"
    )
    result = upsert_latest(None, rows, "id")
    assert "WindowGroupLimit" in result._jdf.queryExecution().executedPlan().toString()
    assert result.count() == 200_001
    assert result.where("id = '0'").first().collected_at == 299_997
