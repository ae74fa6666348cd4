from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opinara.functions.batch import batch_key
from opinara.sources.archives import is_safe
from opinara.sources import objects as objects_module
from opinara.sources.objects import (batch_of, batches, entity_name, latest_batch, list_objects,
                                     newest_batch_key, newest_folder, select_paths)

NAMES = [
    "2024-01-02-10-00/emails_feedback_faker/a.eml",
    "2024-01-02-10-00/emails_feedback_faker/b.EML",
    "2024-01-02-10-00/emails_feedback_faker_old/c.eml",
    "2024-01-02-10-00/set_review.json",
    "2024-01-02-10-005/set_review.json",
    "2024-01-01-10-00/set_business.json",
    "zz-notes/x.json",
    "2024-01-03-10-00",
]


@pytest.fixture
def objects(spark):
    return spark.createDataFrame([(n,) for n in NAMES], "name string")


def test_only_date_folders_are_batches(objects):
    assert [r[0] for r in batches(objects).collect()] == ["2024-01-02-10-00", "2024-01-01-10-00"]


def test_latest_batch(objects):
    names = [r["name"] for r in latest_batch(objects).collect()]
    assert sorted(names) == sorted(NAMES[:4])


def test_nothing_listed_is_an_error(spark):
    empty = spark.createDataFrame([("x.json",), ("notes/y.json",)], "name string")
    assert latest_batch(empty).isEmpty()
    with pytest.raises(ValueError, match="no batch"):
        newest_batch_key(empty.select(batch_of(F.col("name")).alias("batch")))


def test_select_paths(objects):
    def names(**options):
        return sorted(r[0] for r in select_paths(objects, **options).collect())

    assert names(folder="emails_feedback_faker", suffix=".eml") == [NAMES[0]]
    assert names(suffix=".json", containing="business") == [NAMES[5]]


def test_entity_name(spark):
    rows = [("b/set_review.json", "review"), ("b/review.json", "review"), ("b/d/my_set_tip.json.gz", "tip")]
    df = spark.createDataFrame(rows, "name string, entity string")
    assert df.where(entity_name(F.col("name")) != F.col("entity")).isEmpty()


def test_listing_does_not_read_content(spark, tmp_path):
    (tmp_path / "b/sub dir").mkdir(parents=True)
    (tmp_path / "b/sub dir/x'1.txt").write_text("hello")
    (tmp_path / "other.txt").write_text("x")
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        found = list_objects(spark, root, "b/")
        assert [(r["name"], r["length"]) for r in found.collect()] == [("b/sub dir/x'1.txt", 5)]
    assert list_objects(spark, str(tmp_path), "b/su").count() == 1 and list_objects(spark, str(tmp_path), "b/x/y").count() == 0


def test_every_object_is_listed_and_only_the_prefix_is_read(spark, tmp_path):
    names = ["b/a.eml", "b/_b.eml", "b/.c.eml", "b/empty.eml", "b/_d/e.eml", "f.eml"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if "empty" in name else name.encode())
    (tmp_path / "old").mkdir()
    (tmp_path / "old/unreadable.eml").symlink_to(tmp_path / "missing")
    assert {r["name"] for r in list_objects(spark, str(tmp_path)).collect()} >= set(names)
    read = list_objects(spark, str(tmp_path), "b/", content=True).collect()
    assert {r["name"]: bytes(r["content"]) for r in read} == {n: b"" if "empty" in n else n.encode() for n in names[:5]}


def test_the_newest_folder_is_found_from_the_top(spark, tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="no batch"):
        newest_folder(spark, str(tmp_path))
    for name in ("2024-01-01-00-00/a/x.eml", "2024-01-02-00-00/_y", "zzz/x.eml", "2024-01-03-00-00x/x"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    (tmp_path / "2024-01-04-00-00/empty").mkdir(parents=True)
    (tmp_path / "2024-01-05-00-00").write_text("a file")
    listed, below = [], objects_module._list_folders
    monkeypatch.setattr(objects_module, "_list_folders", lambda files, root, deep: listed.append(sorted(r["name"] for r in files.collect())) or below(files, root, deep))
    assert newest_folder(spark, f"{tmp_path}/") == "2024-01-02-00-00"
    assert not [n for names in listed for n in names if n.startswith("2024-01-01") or n.startswith("zzz")]


def test_a_flat_folder_comes_in_bounded_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(objects_module, "FLUSH_NAMES", 7)
    for k in range(30):
        (tmp_path / f"{k}.txt").write_text("x")
    assert {r["name"] for r in list_objects(spark, str(tmp_path)).collect()} == {f"{k}.txt" for k in range(30)}


def test_batch_key_is_local_time(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 2, 5),)], "ts timestamp_ntz")
    ts = F.col("ts").cast("timestamp")
    assert df.select(batch_key(ts)).first()[0] == "2023-12-31-23-05"


def test_names_that_leave_the_folder(spark):
    rows = [("a/b", True), ("a..b", True), ("..", False), ("../a", False), ("a/../b", False), ("/a", False), ("a/..", False)]
    df = spark.createDataFrame(rows, "name string, safe boolean")
    assert df.where(is_safe(F.col("name")) != F.col("safe")).isEmpty()
