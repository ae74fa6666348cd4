"""The archive data source: what it reads, and what a choice of names spares it."""

import io
import os
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from opinara.sources.members import ArchiveReader, read_members
from test_archives import FILES, archive  # noqa: F401  (a fixture)


def put_together(df):
    found = {}
    for r in df.orderBy("archive", "member", "piece").collect():
        assert r["piece"] == 0 or r["member"] in found
        found[r["member"]] = found.get(r["member"], b"") + bytes(r["content"])
    return found


@pytest.mark.parametrize("piece,task", [(1000, 5000), (4 << 20, 128 << 20)])
def test_every_kind_comes_back_whole(spark, archive, piece, task):
    path, kind = archive
    rows = read_members(spark, path, kind, pieceBytes=piece, taskBytes=task)
    assert rows.agg(F.max(F.length("content"))).first()[0] <= piece
    assert put_together(rows) == FILES
    some = read_members(spark, path, kind, prefix="d/", pieceBytes=piece, taskBytes=task).where("size > 100")
    assert put_together(some) == {n: d for n, d in FILES.items() if n.startswith("d/") and len(d) > 100}


def planned(path, kind, task=1000, **names):
    reader = ArchiveReader(path, kind, 100, task, **names)
    parts = reader.partitions()
    rows = [row for part in parts for batch in reader.read(part) for row in batch.to_pylist()]
    return parts, {r["member"] for r in rows}


def test_names_choose_the_tasks(tmp_path):
    path = str(tmp_path / "a.tar")
    with tarfile.open(path, "w") as t:
        for n in range(50):
            info = tarfile.TarInfo(f"d{n % 5}/{n}.txt")
            info.size = 400
            t.addfile(info, io.BytesIO(b"x" * 400))
    parts, names = planned(path, "tar", prefix="d3/")
    assert len(parts) == 5 and names == {f"d3/{n}.txt" for n in range(3, 50, 5)}
    parts, names = planned(path, "tar", containing="4/4", suffix="9.txt")
    assert len(parts) == 1 and parts[0].begin == parts[0].end and names == {"d4/49.txt"}
    assert planned(path, "tar", prefix="none")[1] == set()
    parts, _ = planned(path, "tar", task=200)
    assert len(parts) == 100 and {(p.start, p.stop) for p in parts} == {(0, 200), (200, 400)}


def test_other_members_are_not_opened(spark, tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("good.txt", b"good " * 100)
        z.writestr("broken.txt", b"BROKEN")
    path.write_bytes(path.read_bytes().replace(b"BROKEN", b"CHANGE"))
    rows = read_members(spark, str(path), "zip")
    assert put_together(read_members(spark, str(path), "zip", containing="good")) == {"good.txt": b"good " * 100}
    with pytest.raises(Exception, match="bad checksum"):
        rows.collect()


def test_the_last_of_a_name_in_an_archive_counts(spark, tmp_path):
    path = str(tmp_path / "a.tar")
    with tarfile.open(path, "w") as t:
        for data in (b"old", b"other", b"new"):
            info = tarfile.TarInfo("y" if data == b"other" else "x")
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    assert put_together(read_members(spark, path, "tar")) == {"x": b"new", "y": b"other"}


def test_folders_of_archives(spark, tmp_path):
    for name in ("a.zip", "in/b.zip", "_hidden.zip", "none.zip"):
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            if name != "none.zip":
                z.writestr("same.txt", name)
                z.writestr("é/long " + "n" * 150, name)
    rows = read_members(spark, str(tmp_path), "zip")
    assert sorted(bytes(r["content"]).decode() for r in rows.where("member = 'same.txt'").collect()) == ["a.zip", "in/b.zip"]
    assert read_members(spark, str(tmp_path), "zip", prefix="é/").where(F.col("archive").endswith("/b.zip")).count() == 1
    assert read_members(spark, str(tmp_path / "none.zip"), "zip").count() == 0
    with pytest.raises(Exception, match="kind zip or tar"):
        read_members(spark, str(tmp_path), "rar").count()
    with pytest.raises(Exception, match="no-such"):
        read_members(spark, str(tmp_path / "no-such"), "zip").count()


def test_one_frame_may_be_filtered_in_many_ways(spark, tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        for name in "abc":
            z.writestr(name, name)
    rows = read_members(spark, path, "zip")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW members_of_a USING archive OPTIONS (path '{path}', kind 'zip')")
    for df in (rows, spark.table("members_of_a")):
        assert [df.where("member = 'a'").count(), df.count(), df.where("member IN ('b', 'c')").count(), df.count()] == [1, 3, 2, 3]
        assert df.where("member = 'a'").unionByName(df.where("member = 'b'")).unionByName(df).count() == 5


@pytest.mark.parametrize("front", [b"", b"#!/bin/sh\n" * 9])
def test_a_task_reads_its_own_part_of_a_zips_directory(tmp_path, monkeypatch, front):
    path, names = str(tmp_path / "many.zip"), [f"é{i}/x.txt" for i in range(500)]
    with open(path, "wb") as out:
        out.write(front)
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as made:
            for name in names:
                made.writestr(name, name * 20)
            made.comment = b"end"
    if front:  # written behind other bytes and counted from its own start
        with open(path, "rb") as whole, open(path + ".sfx", "wb") as out:
            out.write(front + whole.read())
        path += ".sfx"
    reader = ArchiveReader(path, "zip", 100, 1000)
    parts = reader.partitions()
    opened = []
    real = zipfile.ZipFile

    def counted(*a, **k):
        archive = real(*a, **k)
        opened.append(len(archive.infolist()))
        return archive

    monkeypatch.setattr(zipfile, "ZipFile", counted)
    found = {}
    for part in parts:
        for batch in reader.read(part):
            for row in batch.to_pylist():
                found[row["member"]] = found.get(row["member"], b"") + row["content"]
    assert found == {name: (name * 20).encode() for name in names}
    assert len(parts) > 50 and sum(opened) == len(names)


def test_a_directory_in_another_order_than_the_members(tmp_path):
    path = str(tmp_path / "turned.zip")
    with zipfile.ZipFile(path, "w") as made:
        for i in range(60):
            made.writestr(f"{i % 50}.txt", f"{i} " * 50)
        made.filelist.sort(key=lambda info: -info.header_offset)
    reader = ArchiveReader(path, "zip", 100, 500)
    rows = [row for part in reader.partitions() for batch in reader.read(part) for row in batch.to_pylist()]
    found = {}
    for row in rows:
        found[row["member"]] = found.get(row["member"], b"") + row["content"]
    assert found == {f"{i % 50}.txt": (f"{i + 50 if i < 10 else i} " * 50).encode() for i in range(50)}
