"""Archives as a Spark data source: ``read_members``, or ``spark.read.format("archive")``.

For picking members out of archives by name. The options ``prefix``, ``suffix`` and
``containing`` go to the planning, which walks the member lists (the directory of a
zip, the headers of a plain tar) and plans tasks for the members that pass only.
A task then goes straight to its part of the archive, and of a zip's directory reads
only the entries of its own members. What planning keeps is one row a task, and the
names that pass of one archive at a time.

Names are chosen by options, not by filters that Spark pushes down: Spark 4.1 keeps
one reader for all scans of a DataFrame, so that two differently filtered uses of it in
one query, or an unfiltered use after a filtered one, would both get the last filter's rows.

To read whole archives of very many members, ``archives.read_archive`` lists the
members in parallel and spreads them by hash.
"""

import io
import struct
import tarfile
import zipfile
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .archives import (
    DEFLATED, LOST, OTHER, PIECE_BYTES, RANGE, STORED, STREAM, TASK_BYTES, _flushed, _name_is_safe, _open, _range_start,
    _read_range, _resized, _Seekable, filesystem, members_of)

FORMAT = "archive"
SCHEMA = "archive string, member string, size bigint, piece int, content binary"


@dataclass
class Part(InputPartition):
    """Members whose places lie in ``[begin, end]``, or the bytes ``[start, stop)`` of one; ``old`` places are replaced.

    ``listed`` is where a zip's directory tells of them, first and last byte, and
    ``shift`` what has to be added to the places it tells.
    """

    archive: str
    begin: int = 0
    end: int | None = None
    start: int = 0
    stop: int | None = None
    old: tuple = ()
    listed: tuple = ()
    shift: int = 0


def _zip_row(path, info):
    method = OTHER if info.flag_bits & 1 else {zipfile.ZIP_STORED: STORED, zipfile.ZIP_DEFLATED: DEFLATED}.get(info.compress_type, OTHER)
    return info.header_offset, {
        "archive": path, "member": info.filename, "size": info.file_size, "offset": info.header_offset,
        "packed": info.compress_size, "crc": info.CRC, "method": method, LOST: None}


def _directory(handle):
    """The entries of a zip in order of their places, each with its range of bytes in the directory, and what is added to the places told there."""
    with zipfile.ZipFile(_Seekable(handle)) as archive:
        infos, start = archive.infolist(), archive.start_dir
    handle.seek(0, 2)
    end = handle.tell()
    handle.seek(start)
    data = handle.read(end - start)  # as the library does, the directory of one archive at a time
    at, shift, found = 0, 0, []
    for info in infos:
        told, = struct.unpack_from("<L", data, at + 42)
        if told != 0xFFFFFFFF:
            shift = info.header_offset - told
        size = 46 + sum(struct.unpack_from("<HHH", data, at + 28))
        found.append((info, start + at, start + at + size))
        at += size
    return sorted(found, key=lambda e: e[0].header_offset), shift


def _listed(handle, begin, end, shift):
    """The entries in one range of bytes of a zip's directory, read as the directory of an archive of their own."""
    handle.seek(begin)
    entries = handle.read(end - begin)
    tail = struct.pack("<4s4H2LH", b"PK\x05\x06", 0, 0, 0, 0, len(entries), 0, 0)
    with zipfile.ZipFile(io.BytesIO(entries + tail)) as archive:
        infos = archive.infolist()
    for info in infos:
        info.header_offset += shift
    return sorted(infos, key=lambda i: i.header_offset)


def _entries(handle, path, kind, begin=0, end=None, listed=(), shift=0):
    """``(place, index row)`` of the regular members whose places lie in ``[begin, end]``, in order of their places."""
    if kind == "zip":
        for info in _listed(handle, *listed, shift) if listed else []:
            if not info.is_dir() and info.header_offset >= begin and (end is None or info.header_offset <= end):
                yield _zip_row(path, info)
        return
    handle.seek(begin)
    try:
        archive = tarfile.open(fileobj=handle, mode="r:")
    except tarfile.ReadError:  # compressed: its members are known only once it has been read
        yield 0, {"archive": path, "member": None, "size": 0, "method": STREAM, LOST: None}
        return
    with archive:
        for info in archive:
            archive.members = []
            if end is not None and info.offset > end:
                return
            if info.isfile():
                yield info.offset, {
                    "archive": path, "member": info.name, "size": info.size, "offset": info.offset_data,
                    "packed": None, "crc": None, "method": OTHER if info.sparse else RANGE, LOST: None}


class ArchiveReader(DataSourceReader):
    def __init__(self, path, kind, piece_bytes, task_bytes, prefix="", suffix="", containing=""):
        self.path, self.kind, self.piece_bytes = path, kind, piece_bytes
        self.task_bytes = max(piece_bytes, task_bytes // piece_bytes * piece_bytes)
        self.prefix, self.suffix, self.containing = prefix, suffix, containing

    def _wanted(self, name):
        return (name.startswith(self.prefix) and name.endswith(self.suffix) and self.containing in name
                and _name_is_safe(name))

    def _archives(self):
        """Paths of the archives, with the scheme that was given; hidden names are passed over, as Spark does."""
        files, root = filesystem(self.path)
        info = files.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.type == fs.FileType.File:
            return [self.path]
        base = self.path.rstrip("/")
        inner = [i.path[len(root.rstrip("/")):] for i in files.get_file_info(fs.FileSelector(root, recursive=True)) if i.is_file]
        return sorted(base + p for p in inner if not any(n.startswith((".", "_")) for n in p.split("/")))

    def partitions(self):
        return [part for path in self._archives() for part in self._plan(path)] or [Part("")]

    def _plan(self, path):
        last, old, listed, shift = {}, [], {}, 0
        with _open(path) as handle:
            if self.kind == "zip":
                infos, shift = _directory(handle)
                entries = []
                for info, *place in infos:
                    if not info.is_dir() and self._wanted(info.filename):
                        entries.append(_zip_row(path, info))
                        listed[info.header_offset] = place
            else:
                entries = _entries(handle, path, self.kind)
            for place, row in entries:
                if row["method"] == STREAM:
                    return [Part(path)]
                if self._wanted(row["member"]):
                    if row["member"] in last:
                        old.append(last.pop(row["member"])[0])
                    last[row["member"]] = (place, row["size"], row["method"] in (RANGE, STORED))
        old.sort()
        parts, held = [], []

        def add(places, start=0, stop=None):
            begin, end = places[0], places[-1]
            ranges = [listed[p] for p in places if p in listed]
            span = (min(r[0] for r in ranges), max(r[1] for r in ranges)) if ranges else ()
            replaced = tuple(old[bisect_left(old, begin):bisect_right(old, end)])
            parts.append(Part(path, begin, end, start, stop, replaced, span, shift))

        size_held = 0
        for place, size, cuttable in sorted(last.values()):
            if held and (size_held + size > self.task_bytes):
                add(held)
                held, size_held = [], 0
            if cuttable and size > self.task_bytes:
                for at in range(0, size, self.task_bytes):
                    add([place], at, min(at + self.task_bytes, size))
                continue
            held.append(place)
            size_held += size
        if held:
            add(held)
        return parts

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()),
                            ("piece", pa.int32()), ("content", pa.binary())])
        if partition.archive:
            yield from _flushed(self._pieces(partition), schema, lambda r: len(r["content"]))

    def _pieces(self, part):
        with _open(part.archive) as handle:
            for place, row in _entries(handle, part.archive, self.kind, part.begin, part.end, part.listed, part.shift):
                if place in part.old or not (row["method"] == STREAM or self._wanted(row["member"])):
                    continue
                if part.stop is not None:
                    chunks = _read_range(handle, _range_start(handle, row) + part.start, part.stop - part.start)
                    found = [(row["member"], row["size"], chunks)]
                else:
                    found = members_of(handle, row, self.kind)
                for member, size, chunks in found:
                    if self._wanted(member):
                        for number, content in enumerate(_resized(chunks, self.piece_bytes), part.start // self.piece_bytes):
                            yield {"archive": part.archive, "member": member, "size": size, "piece": number, "content": content}


class ArchiveSource(DataSource):
    """Options: ``path`` (an archive, or a folder of them), ``kind`` (``zip`` or ``tar``), ``prefix``, ``suffix`` and
    ``containing`` of the member's name, ``pieceBytes``, ``taskBytes``."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        kind = self.options.get("kind", "zip")
        if kind not in ("zip", "tar") or not self.options.get("path"):
            raise ValueError("an archive source needs a path and the kind zip or tar")
        return ArchiveReader(self.options["path"], kind, int(self.options.get("pieceBytes", PIECE_BYTES)),
                             int(self.options.get("taskBytes", TASK_BYTES)),
                             *[self.options.get(name, "") for name in ("prefix", "suffix", "containing")])


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("archive")`` and ``CREATE TEMPORARY VIEW ... USING archive`` known to the session."""
    spark.dataSource.register(ArchiveSource)


def read_members(spark: SparkSession, path: str, kind: str, **options) -> DataFrame:
    """Rows ``(archive, member, size, piece, content)`` of the members whose names fit ``prefix``, ``suffix`` and ``containing``.

    Other members are not opened. A member of at most ``pieceBytes`` is one row. Of a name
    written twice in one archive the last member counts; several archives give their members
    each. Checksums of a zip are tested, but for stored members larger than a task's share.
    Directories, links and names that would leave the target folder are not read;
    an archive without members that fit gives no task, and none gives no rows.
    """
    register(spark)
    return spark.read.format(FORMAT).options(kind=kind, **options).load(path)
