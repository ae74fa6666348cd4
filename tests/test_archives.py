import io
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from opinara.sinks.batches import newest_batch, write_batch, write_member_files
from opinara.sources import archives

FILES = {f"d/{i}.eml": (f"line {i}\n" * (i * 37)).encode() for i in range(40)} | {
    "empty.json": b"", "big.json": b"".join(b'{"n": %d}\r\n' % i for i in range(3000)),
    "no_end.json": b"a\nb\n\nc"}


def make_zip(path, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as z:
        z.writestr("d/", b"")
        for name, data in FILES.items():
            z.writestr(name, data)
        z.writestr("../evil.json", b"x")


def make_tar(path, mode="w"):
    with tarfile.open(path, mode) as t:
        folder = tarfile.TarInfo("d")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for name, data in FILES.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
        link = tarfile.TarInfo("link.json")
        link.type, link.linkname = tarfile.SYMTYPE, "big.json"
        t.addfile(link)
        evil = tarfile.TarInfo("/etc/evil.json")
        evil.size = 1
        t.addfile(evil, io.BytesIO(b"x"))


KINDS = {
    "zip": lambda p: make_zip(p),
    "zip-stored": lambda p: make_zip(p, zipfile.ZIP_STORED),
    "zip-bz2": lambda p: make_zip(p, zipfile.ZIP_BZIP2),
    "tar": lambda p: make_tar(p),
    "tar-gz": lambda p: make_tar(p, "w:gz"),
    "tar-xz": lambda p: make_tar(p, "w:xz"),
}


@pytest.fixture(params=list(KINDS))
def archive(request, tmp_path):
    path = str(tmp_path / "archive.bin")
    KINDS[request.param](path)
    return path, request.param.split("-")[0]


def test_members_come_back_whole(spark, archive):
    path, kind = archive
    pieces = archives.read_archive(spark, path, kind, piece_bytes=1000)
    assert pieces.agg(F.max(F.length("content"))).first()[0] <= 1000
    found = {r["member"]: bytes(r["content"])
             for r in archives.whole_members(pieces).collect()}
    assert found == FILES


@pytest.mark.parametrize("piece", [7, 11, 500, 1 << 20])
def test_lines_are_complete_at_any_piece_size(spark, archive, piece):
    path, kind = archive
    rows = archives.read_archive_lines(spark, path, kind, ".json", piece).collect()
    found = {}
    for r in rows:
        found.setdefault(r["member"], []).append(r["value"])
    for name in ("big.json", "no_end.json"):
        assert sorted(found[name]) == sorted(FILES[name].decode().splitlines())
    assert set(found) == {"big.json", "no_end.json"}


def test_files_are_written_as_they_were(spark, archive, tmp_path):
    path, kind = archive
    index = archives.member_index(spark, path, kind)
    written = write_member_files(index, kind, str(tmp_path / "out"), "2024-01-01-00-00").collect()
    assert {r["member"]: r["size"] for r in written} == {n: len(d) for n, d in FILES.items()}
    for name, data in FILES.items():
        assert (tmp_path / "out/2024-01-01-00-00" / name).read_bytes() == data
    assert sum(1 for p in (tmp_path / "out").rglob("*") if p.is_file()) == len(FILES)


def test_damaged_member_is_an_error(spark, tmp_path):
    path = tmp_path / "a.zip"
    make_zip(path)
    data = bytearray(path.read_bytes())
    at = data.find(b"big.json") + 200
    data[at:at + 4] = b"\0\0\0\0"
    path.write_bytes(bytes(data))
    with pytest.raises(Exception):
        archives.read_archive(spark, str(path), "zip").agg(F.sum(F.length("content"))).collect()


def test_newest_batch_reads_one_partition(spark, tmp_path):
    root = str(tmp_path / "landing")
    df = spark.createDataFrame([("a", 1)], "member string, n int")
    for batch in ("2024-01-01-10-00", "2024-01-02-09-00", "2024-01-02-09-00"):
        write_batch(df, root, batch)
    newest = newest_batch(spark, root)
    assert [tuple(r) for r in newest.collect()] == [("a", 1, "2024-01-02-09-00")]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


TWICE = [("x.eml", b"A" * 10), ("y.eml", b"y"), ("x.eml", b"B" * 12)]


@pytest.mark.parametrize("kind", list(KINDS))
@pytest.mark.parametrize("piece", [4, 1000])
def test_the_last_of_a_name_wins(spark, tmp_path, kind, piece):
    path, (form, _, packing) = str(tmp_path / "a.bin"), kind.partition("-")
    if form == "zip":
        method = {"": zipfile.ZIP_DEFLATED, "stored": zipfile.ZIP_STORED, "bz2": zipfile.ZIP_BZIP2}[packing]
        with zipfile.ZipFile(path, "w", method) as z:
            for name, data in TWICE:
                z.writestr(name, data)
    else:
        with tarfile.open(path, f"w:{packing}") as t:
            for name, data in TWICE:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    rows = archives.whole_members(archives.read_archive(spark, path, form, piece)).collect()
    assert sorted((r["member"], bytes(r["content"])) for r in rows) == [("x.eml", b"B" * 12), ("y.eml", b"y")]


@pytest.mark.parametrize("piece", [4, 1000])
def test_damage_in_a_stored_member_is_an_error(spark, tmp_path, piece):
    path = tmp_path / "s.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.txt", b"hello world")
    path.write_bytes(path.read_bytes().replace(b"hello", b"HALLO"))
    with pytest.raises(Exception, match="checksum"):
        archives.whole_members(archives.read_archive(spark, str(path), "zip", piece)).collect()


def test_lines_that_are_not_text_are_missing(spark, tmp_path):
    path = str(tmp_path / "l.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.json", b"one\r\n\xff\n\n\xc3\xa9")
    values = [r["value"] for r in archives.read_archive_lines(spark, path, "zip").collect()]
    assert sorted(map(str, values)) == ["", "None", "one", "é"]


def test_store_names_of_spark_are_understood(monkeypatch):
    asked = []
    monkeypatch.setattr(archives.fs, "FileSystem", type("Fake", (), {"from_uri": staticmethod(lambda uri: asked.append(uri) or (None, uri))}))
    for uri in ("s3a://b/k.zip", "s3n://b/k", "gs://b/k", "hdfs://h/k"):
        archives.filesystem(uri)
    assert asked == ["s3://b/k.zip", "s3://b/k", "gs://b/k", "hdfs://h/k"]


def test_a_member_too_large_for_a_row_is_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "z.zip")
    make_zip(path, zipfile.ZIP_STORED)
    monkeypatch.setattr(archives, "WHOLE_BYTES", 2000)
    with pytest.raises(Exception, match="too large"):
        archives.whole_members(archives.read_archive(spark, path, "zip", 500)).collect()


def test_an_empty_zip_has_no_members(spark, tmp_path):
    for comment in (b"", b"nothing here"):
        with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
            z.comment = comment
        assert archives.read_archive(spark, str(tmp_path / "e.zip"), "zip").count() == 0


@pytest.mark.parametrize("kind", ["zip", "tar", "tar.gz"])
def test_the_last_archive_of_a_name_wins(spark, tmp_path, kind):
    versions = {"a": [("x.eml", b"old"), ("only.eml", b"o")], "b": [("y.eml", b"y"), ("x.eml", b"older"), ("x.eml", b"newer")], "c": [("y.eml", b"Y"), ("d/x.eml", b"d")]}
    for name, members in versions.items():
        path = str(tmp_path / f"{name}.bin")
        if kind == "zip":
            with zipfile.ZipFile(path, "w") as z:
                for member, data in members:
                    z.writestr(member, data)
        else:
            with tarfile.open(path, "w:gz" if kind == "tar.gz" else "w") as t:
                for member, data in members:
                    info = tarfile.TarInfo(member)
                    info.size = len(data)
                    t.addfile(info, io.BytesIO(data))
    form = kind.partition(".")[0]
    due = [("d/x.eml", b"d"), ("only.eml", b"o"), ("x.eml", b"newer"), ("y.eml", b"Y")]
    rows = archives.whole_members(archives.read_archive(spark, str(tmp_path), form)).collect()
    assert sorted((r["member"], bytes(r["content"])) for r in rows) == due
    write_member_files(archives.member_index(spark, str(tmp_path), form), form, str(tmp_path / "out"), "b").collect()
    found = {str(p.relative_to(tmp_path / "out/b")): p.read_bytes() for p in (tmp_path / "out/b").rglob("*.eml")}
    assert sorted(found.items()) == due


def test_blocks_of_lines_stay_small():
    text = b"".join(b"%d %s\n" % (i, b"x" * (i % 3000)) for i in range(8000)) + b"y" * (3 << 20) + b"\nlast"
    chunks = (text[at:at + (4 << 20)] for at in range(0, len(text), 4 << 20))
    blocks = list(archives._blocks(chunks))
    assert b"\n".join(blocks) == text
    assert max(len(b) for b in blocks if b"y" not in b) <= 2 << 20
