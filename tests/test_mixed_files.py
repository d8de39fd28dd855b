"""Stored files that differ in the physical types of their columns."""

import pandas as pd
import pytest

from clipledger.sources import footers, tables
from clipledger.sources.contracts import VIDEO_SCHEMA


def write(folder, name, **columns):
    folder.mkdir(parents=True, exist_ok=True)
    pd.DataFrame(columns).to_parquet(folder / name, index=False)


@pytest.fixture
def mixed(tmp_path):
    root = tmp_path / "video"
    write(root / "client=007", "a.parquet", video_id=["1", "2"], like_count=[1, 2])
    write(root / "client=007", "b.parquet", video_id=["3", "4"], like_count=[3.0, None])
    write(root / "client=x y", "c.parquet", video_id=["5"], like_count=[None], note=[1])
    write(root / "client=x y", "d.parquet", video_id=["6"], transcript=[None])
    write(root / "client=x y", "e.parquet", like_count=["8"], video_id=["7"])
    (root / "client=x y" / "zero.parquet").touch()
    return root


WANTED = {
    ("1", "007", 1), ("2", "007", 2), ("3", "007", 3), ("4", "007", None), ("5", "x y", None),
    ("6", "x y", None), ("7", "x y", 8),
}


def rows(found):
    assert found.schema.simpleString() == VIDEO_SCHEMA.simpleString()
    return {(row.video_id, row.client, row.like_count) for row in found.collect()}


def test_kinds(spark, mixed):
    kinds = {
        row.path.rsplit("/", 1)[1]: row.kind
        for row in footers.file_kinds(spark, str(mixed), ["video_id", "like_count"]).collect()
    }
    assert kinds["a.parquet"] == "video_id string; like_count int64"
    assert kinds["b.parquet"] == "video_id string; like_count double"
    assert kinds["d.parquet"] == "video_id string" and len(kinds) == 5
    assert len(footers.by_kind(spark, str(mixed), ["video_id", "like_count"])) == 5
    assert footers.by_kind(spark, str(mixed), ["video_id"]) == []


@pytest.mark.parametrize("merge", [False, True])
def test_scan(spark, mixed, merge):
    (mixed / "client=x y" / "zero.parquet").unlink()
    assert rows(tables.contract_scan(spark, str(mixed), VIDEO_SCHEMA, merge)) == WANTED


def test_scan_of_a_glob(spark, mixed):
    """Folders that a glob names are no partition columns, as in any scan of a glob."""
    (mixed / "client=x y" / "zero.parquet").unlink()
    found = rows(tables.contract_scan(spark, str(mixed / "client=*"), VIDEO_SCHEMA))
    assert found == {(video, None, likes) for video, _, likes in WANTED}
    files = rows(tables.contract_scan(spark, str(mixed / "client=007" / "*.parquet"), VIDEO_SCHEMA))
    assert files == {("1", None, 1), ("2", None, 2), ("3", None, 3), ("4", None, None)}


def test_client_folders_are_pruned(spark, mixed):
    (mixed / "client=x y" / "zero.parquet").unlink()
    one = tables.contract_scan(spark, str(mixed), VIDEO_SCHEMA).where("client = '007'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(client") >= 1
    assert rows(one) == {row for row in WANTED if row[1] == "007"}


def test_views(spark, mixed, tmp_path):
    (mixed / "client=x y" / "zero.parquet").unlink()
    tables.table_views(spark, str(mixed), str(tmp_path / "none"))
    assert spark.sql("SELECT sum(like_count) FROM video WHERE client = 'x y'").first()[0] == 8
    assert spark.sql("SELECT count(*) FROM comments").first()[0] == 0


def test_broken_files_are_left_to_spark(spark, tmp_path):
    write(tmp_path / "v", "a.parquet", video_id=["1"], like_count=[1])
    (tmp_path / "v" / "b.parquet").write_bytes(b"PAR1 cut")
    assert footers.by_kind(spark, str(tmp_path / "v"), ["like_count"]) == []
    with pytest.raises(Exception):
        tables.contract_scan(spark, str(tmp_path / "v"), VIDEO_SCHEMA).collect()
