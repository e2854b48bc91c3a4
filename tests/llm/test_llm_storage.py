"""Folders of interim results, and addresses of file systems."""

import os

from deliverylens.llm import storage
from deliverylens.llm.components import connected_components
from deliverylens.session import scratch_dir


def left(spark):
    top = scratch_dir(spark)
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_interim_folders_go_once_they_are_read(spark):
    before, mark = left(spark), storage.folders_made()
    first = storage.written(spark.range(5).toDF("a"), "first")
    second = storage.written(first.selectExpr("a + 1 AS a"), "second")
    assert len(left(spark) - before) == 2
    storage.drop_folders(spark, mark, keep=1)
    assert [n.partition("-")[0] for n in left(spark) - before] == ["second"]
    assert second.count() == 5
    storage.drop_folders(spark, mark)
    assert left(spark) == before and storage.folders_made() == mark


def test_rounds_of_components_leave_one_folder(spark):
    before, mark = left(spark), storage.folders_made()
    chain = spark.range(40).selectExpr("id AS a", "id + 1 AS b")
    found = connected_components(chain)
    assert len(left(spark) - before) == 1
    assert {r.component for r in found.collect()} == {0} and found.count() == 41
    storage.drop_folders(spark, mark)


def test_addresses_of_shared_folders(tmp_path, monkeypatch):
    system, path = storage.open_folder(f"file://{tmp_path}")
    assert path == str(tmp_path) and system.get_file_info(path).type.name == "Directory"
    monkeypatch.setattr(storage.fs, "FileSystem", type("Any", (), {"from_uri": staticmethod(lambda uri: uri)}))
    assert storage.open_folder("s3a://bucket/a:b") == "s3://bucket/a:b"
    assert storage.open_folder("abfss://c@account/x") == "abfs://c@account/x"
    assert storage.open_folder("hdfs://name/x") == "hdfs://name/x"
