from types import SimpleNamespace

import pytest
from pyarrow import fs

from caseweave.sources import listing
from caseweave.sources.listing import ListingReader, list_prefixes
from caseweave.sources.requests import list_objects, with_object_id


def test_many_files_one_partition_per_prefix(spark, tmp_path, rows):
    for f in range(100):
        folder = tmp_path / f"day={f:03d}"
        folder.mkdir()
        for n in range(100):
            (folder / f"{f * 100 + n}.jpg").write_bytes(b"x")
    found = list_prefixes(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 101  # and one for files beside the folders
    assert found.count() == 10_000
    assert rows(found) == rows(list_objects(spark, str(tmp_path)))


def test_nested_hidden_and_other_names(spark, tmp_path, rows):
    for name in ("1.jpg", "a/2.jpg", "a/b/c/3.jpg", "a/4.png", "a/5 ü%20.jpg", "_tmp/6.jpg", "a/.7.jpg", "a/_x/8.jpg", "z/9.jpg._COPYING_"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    (tmp_path / "empty").mkdir()
    (tmp_path / "a" / "10.jpg").touch()
    for glob in ("*.jpg", "*", "?.jpg", "[12].jpg"):
        assert rows(list_prefixes(spark, str(tmp_path), glob)) == rows(list_objects(spark, str(tmp_path), glob))
    ids = {r.service_request_id for r in with_object_id(list_prefixes(spark, str(tmp_path))).collect()}
    assert ids == {"1", "2", "3", "20"}  # the digits before ".jpg"


def test_empty_and_missing_folder(spark, tmp_path):
    assert list_prefixes(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="(?i)not exist|no such|not found"):
        list_prefixes(spark, str(tmp_path / "none")).count()


@pytest.mark.parametrize(
    ("folder", "root", "start"),
    [("gs://bucket/photos", "bucket/photos", "gs://"), ("s3://bucket", "bucket", "s3://"), ("hdfs://name:8020/photos", "/photos", "hdfs://name:8020")],
)
def test_uris_of_remote_stores(monkeypatch, folder, root, start):
    """Object stores give the bucket back in the path, others leave the host out of it."""
    store = SimpleNamespace(from_uri=lambda uri: (object(), root))
    monkeypatch.setattr(listing, "fs", SimpleNamespace(FileSystem=store, LocalFileSystem=fs.LocalFileSystem))
    _, found, prefix = ListingReader(folder, "*")._store()
    assert (found, prefix + found) == (root, folder) and prefix == start
