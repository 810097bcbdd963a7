"""Builds that are seen whole: a job that breaks midway, readers of the build before, counts from writing."""

import zipfile

import pytest

from spendlens.sources import archives, catalog, published
from tests.helpers import tuples


def put(folder, name, text):
    with zipfile.ZipFile(folder / name, "w") as archive:
        archive.writestr("sheet.csv", text)


def test_a_broken_rebuild_changes_nothing(spark, tmp_path, monkeypatch):
    folder, target = tmp_path / "zips", str(tmp_path / "tables")
    folder.mkdir()
    put(folder, "1-1_XX_2024_one.zip", "a,b\n1,x\n2,\n")
    put(folder, "2-1_XX_2024_two.zip", "a\n5\n")
    with pytest.raises(ValueError, match="nothing is published"):
        catalog.register_views(spark, target)
    archives.ingest(spark, str(folder), target)
    first = published.current(spark, target)
    put(folder, "1-1_XX_2024_one.zip", "a,b\n7,y\n")
    written = archives._written

    def broken(table, path, buckets):
        if path.endswith("tbl_2_1"):
            raise OSError("the store is gone")
        return written(table, path, buckets)

    monkeypatch.setattr(archives, "_written", broken)
    with pytest.raises(OSError):
        archives.ingest(spark, str(folder), target)
    assert published.current(spark, target) == first
    assert catalog.register_views(spark, target) == ["one", "two"]
    reader = spark.table("one")
    assert sorted(tuples(reader)) == [(1, "x"), (2, None)]
    monkeypatch.undo()
    (folder / "2-1_XX_2024_two.zip").unlink()
    archives.ingest(spark, str(folder), target)
    assert sorted(tuples(reader)) == [(1, "x"), (2, None)]  # the build before is still there
    assert catalog.register_views(spark, target) == ["one"] and tuples(spark.table("one")) == [(7, "y")]


def test_counts_come_from_writing(spark, tmp_path):
    folder, target = tmp_path / "zips", str(tmp_path / "tables")
    folder.mkdir()
    put(folder, "1-1_XX_2024_one.zip", "a,`b\n1,x\n2,\n,\n")
    put(folder, "2-1_XX_2024_none.zip", "a\n")
    index = archives.ingest(spark, str(folder), target)
    counts = {(t, c): (n, nulls) for t, c, n, nulls in tuples(catalog.stored_counts(spark, target))}
    assert counts == {("tbl_1_1", "a"): (3, 1), ("tbl_1_1", "`b"): (3, 2), ("tbl_2_1", "a"): (0, 0)}
    assert {v: n for v, n, _ in tuples(catalog.verify(spark, index, target))} == {"one": 3, "none": 0}


def test_builds_are_numbered_and_old_ones_go(spark, tmp_path):
    target = str(tmp_path)
    builds = []
    for i in range(4):
        builds.append(published.new_build(target))
        spark.range(i).write.parquet(f"{builds[-1]}/t")
        assert published.publish(spark, target, builds[-1], {"i": i}) == i + 1
        assert published.current(spark, target) == builds[-1] and published.manifest(spark, target)["i"] == i
    unfinished = published.new_build(target)
    spark.range(1).write.parquet(f"{unfinished}/t")
    assert sorted(published.tidy(spark, target)) == sorted(b.rsplit("/", 1)[1] for b in builds[:2])
    assert spark.read.parquet(f"{builds[2]}/t").count() == 2 and spark.read.parquet(f"{unfinished}/t").count() == 1
    assert published.tidy(spark, target, abandoned_hours=-1) == [unfinished.rsplit("/", 1)[1]]
    assert published.current(spark, target) == builds[-1]


def test_two_builds_at_once(spark, tmp_path, monkeypatch):
    """The second of two that count the same manifests takes the next number."""
    target = str(tmp_path)
    a, b = published.new_build(target), published.new_build(target)
    published.publish(spark, target, a)
    monkeypatch.setattr(published, "_manifests", lambda store, root: [])
    assert published.publish(spark, target, b) == 2
    monkeypatch.undo()
    assert published.current(spark, target) == b
