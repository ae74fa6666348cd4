"""Read zip and tar archives in parallel, member by member and piece by piece.

A first pass lists the members of every archive, one small row each. The list is
cut into pieces and hashed over the cluster, and each task opens the archive and
reads only its own pieces, so no row and no task ever holds more than one piece.

What can be cut depends on the format. Members of a plain tar and stored members
of a zip are byte ranges, read by as many tasks as they have pieces. A deflated
zip member has to be read from its start: one task per member. A compressed tar
has to be read from its start as a whole: one task per archive. Either way the
bytes pass through in pieces.

A name written twice in one archive stands for its last member, as unpacking the
archive would have it. For that the first pass holds the names of one archive; over
a compressed tar it is a pass of its own. A name in several archives stands for that
of the archive whose path is last, as unpacking them in order would have it; names
alone are shuffled for that.
"""

import ctypes
import struct
import tarfile
import zipfile
import zlib
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 4 << 20
FLUSH_BYTES = 8 << 20
FLUSH_ROWS = 2000
BLOCK_BYTES = 1 << 20  # of lines; a worker holds several copies of a block
TASK_BYTES = 128 << 20
WHOLE_BYTES = 1 << 30

# Schemes that Spark's file systems go by, and what Arrow calls the same stores.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "wasbs": "abfss"}

INDEX = "archive string, member string, size bigint, offset bigint, packed bigint, crc bigint, method string"
LOST = "replaced"  # of a compressed tar: its members that a later archive replaces
RANGE, STORED, DEFLATED, OTHER, STREAM = "range", "stored", "deflated", "other", "stream"


def filesystem(path: str):
    """Arrow file system and path of an object, for use inside tasks; takes the schemes that Spark takes."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        scheme, _, rest = path.partition("://")
        return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    return fs.LocalFileSystem(), path


def free():
    """Give memory that this worker no longer uses back to its machine; idle workers stay."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def _open(path):
    files, name = filesystem(path)
    return files.open_input_file(name)


class _Seekable:
    """An open file that tells of a place before its start as Python's own files do; an empty zip is found out that way."""

    def __init__(self, handle):
        self.handle = handle

    def __getattr__(self, name):
        return getattr(self.handle, name)

    def seek(self, *place):
        try:
            return self.handle.seek(*place)
        except pa.ArrowInvalid as error:
            raise OSError(str(error)) from error


# --- first pass: the members ---

def _zip_members(path):
    with _open(path) as handle, zipfile.ZipFile(_Seekable(handle)) as archive:
        last = {info.filename: info for info in archive.infolist() if not info.is_dir()}
        for info in last.values():
            method = OTHER
            if not info.flag_bits & 1:
                method = {zipfile.ZIP_STORED: STORED, zipfile.ZIP_DEFLATED: DEFLATED}.get(
                    info.compress_type, OTHER)
            yield path, info.filename, info.file_size, info.header_offset, info.compress_size, info.CRC, method


def _tar_members(path):
    with _open(path) as handle:
        try:
            archive = tarfile.open(fileobj=handle, mode="r:")
        except tarfile.ReadError:
            # Compressed: the members are known only once it has been read.
            yield path, None, None, 0, None, None, STREAM
            return
        last = {}
        with archive:
            for info in archive:
                if info.isfile():
                    method = OTHER if info.sparse else RANGE
                    last[info.name] = (path, info.name, info.size, info.offset_data, None, None, method)
                archive.members = []
        yield from last.values()


def member_index(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One row per regular member of the archives at ``path`` (a file, folder or glob)."""
    members = {"zip": _zip_members, "tar": _tar_members}[kind]
    archives = spark.read.format("binaryFile").load(path).select("path")

    def scan(batches):
        for batch in batches:
            for archive in batch.column("path").to_pylist():
                rows = []
                for row in members(archive):
                    rows.append(row)
                    if len(rows) == FLUSH_ROWS:
                        yield _index_batch(rows)
                        rows = []
                if rows:
                    yield _index_batch(rows)

    index = archives.mapInArrow(scan, INDEX)
    if archives.limit(2).count() < 2:
        return index.withColumn(LOST, F.lit(None).cast("array<string>"))
    return _last_archives(index, kind)


def _last_archives(index, kind):
    """The index without members that a later archive replaces."""
    def names(batches):
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                with _open(archive) as handle:
                    found = list(_last_places(handle).values())
                yield pa.RecordBatch.from_arrays([pa.array([archive] * len(found), pa.string()), pa.array(found, pa.string())], names=["archive", "member"])

    named = index.where(F.col("member").isNotNull())
    streams = index.where(F.col("member").isNull())
    every = named.select("archive", "member")
    if kind == "tar":
        every = every.union(streams.select("archive").mapInArrow(names, "archive string, member string"))
    last = every.groupBy("member").agg(F.max("archive").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    lost = every.join(last, "member").where(F.col("archive") < F.col("last")).select("archive", "member")
    kept = named.join(lost, ["archive", "member"], "left_anti").withColumn(LOST, F.lit(None).cast("array<string>"))
    if kind != "tar":
        return kept
    of_streams = lost.groupBy("archive").agg(F.collect_list("member").alias(LOST))  # no more than the archive has members
    return kept.unionByName(streams.join(of_streams, "archive", "left").select(kept.columns))


def _index_batch(rows):
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = [field.split()[0] for field in INDEX.split(", ")]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def is_safe(member: Column) -> Column:
    """The name stays inside the folder it is written to."""
    return ~member.rlike(r"\A/|(?:\A|/)\.\.(?:/|\z)")


def _name_is_safe(name):
    return not name.startswith("/") and ".." not in name.split("/")


def _pieces(index: DataFrame, piece_bytes: int) -> DataFrame:
    """Cut the members that are byte ranges and hash all pieces over the cluster."""
    cuttable = F.col("method").isin(RANGE, STORED) & (F.col("size") > 0)
    starts = F.when(cuttable, F.sequence(F.lit(0), F.col("size") - 1, F.lit(piece_bytes)))
    starts = F.coalesce(starts, F.array(F.lit(0).cast("bigint")))
    pieces = _safe(index).select("*", F.posexplode(starts).alias("piece", "start"))
    own = F.when(cuttable, F.least(F.lit(piece_bytes), F.col("size") - F.col("start")))
    return _hashed(pieces.withColumn("piece_size", own), "archive", "member", "piece")


def _safe(index):
    return index.where(F.col("member").isNull() | is_safe(F.col("member")))


def _hashed(rows, *keys):
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.coalesce("piece_size", "packed", "size", F.lit(0)))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    # A fixed number: adaptive execution would merge these tiny rows into one task.
    return rows.drop("piece_size").repartition(tasks, *keys)


def spread_members(index: DataFrame) -> DataFrame:
    """The safe members of an index, hashed over the cluster as wholes."""
    return _hashed(_safe(index).withColumn("piece_size", F.lit(None).cast("bigint")), "archive", "member")


# --- second pass: the bytes ---

def _read_range(handle, begin, length):
    handle.seek(begin)
    while length > 0:
        data = handle.read(min(length, PIECE_BYTES))
        if not data:
            raise EOFError("archive ends inside a member")
        length -= len(data)
        yield data


def _zip_data_offset(handle, offset):
    handle.seek(offset)
    head = handle.read(30)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member at the listed offset")
    name, extra = struct.unpack("<HH", head[26:30])
    return offset + 30 + name + extra


def _inflate(handle, row):
    engine = zlib.decompressobj(-zlib.MAX_WBITS)
    crc = 0
    for packed in _read_range(handle, _zip_data_offset(handle, row["offset"]), row["packed"]):
        while packed:
            data = engine.decompress(packed, PIECE_BYTES)
            crc = zlib.crc32(data, crc)
            yield data
            packed = engine.unconsumed_tail
    data = engine.flush()
    if zlib.crc32(data, crc) != row["crc"]:
        raise zipfile.BadZipFile(f"bad checksum in {row['member']}")
    yield data


def _checked(chunks, row):
    """The chunks of a whole member, with its checksum tested at the end where the archive has one."""
    crc = 0
    for chunk in chunks:
        crc = zlib.crc32(chunk, crc)
        yield chunk
    if row["crc"] is not None and crc != row["crc"]:
        raise zipfile.BadZipFile(f"bad checksum in {row['member']}")


def _copy(stream):
    while data := stream.read(PIECE_BYTES):
        yield data


@lru_cache(maxsize=1)
def _zip_directory(handle):
    """The archive and its members by place, parsed once while the archive stays open."""
    handle.seek(0)
    archive = zipfile.ZipFile(handle)
    return archive, {info.header_offset: info for info in archive.infolist()}


def _other(handle, row, kind):
    """Rare encodings, left to the standard library."""
    if kind == "zip":
        archive, by_offset = _zip_directory(handle)
        with archive.open(by_offset[row["offset"]]) as stream:
            yield from _copy(stream)
    else:
        handle.seek(0)
        with tarfile.open(fileobj=handle, mode="r:") as archive:
            for info in archive:
                if info.offset_data == row["offset"]:
                    yield from _copy(archive.extractfile(info))
                    return
                archive.members = []


def _last_places(handle):
    """Place and name in a compressed tar of the last file of each name."""
    handle.seek(0)
    with tarfile.open(fileobj=handle, mode="r|*") as archive:
        last = {}
        for number, info in enumerate(archive):
            if info.isfile():
                last[info.name] = number
            archive.members = []
        return {number: name for name, number in last.items()}


def _range_start(handle, row):
    """Where the bytes of a member that is a byte range begin in the archive."""
    return _zip_data_offset(handle, row["offset"]) if row["method"] == STORED else row["offset"]


def members_of(handle, row, kind):
    """``(member, size, byte chunks)`` of everything one index row stands for, read from its start."""
    if row["method"] == STREAM:
        last, replaced = _last_places(handle), set(row[LOST] or ())
        handle.seek(0)
        with tarfile.open(fileobj=handle, mode="r|*") as archive:
            for number, info in enumerate(archive):
                if number in last and info.name not in replaced and _name_is_safe(info.name):
                    yield info.name, info.size, _copy(archive.extractfile(info))
                archive.members = []
    elif row["method"] == DEFLATED:
        yield row["member"], row["size"], _inflate(handle, row)
    elif row["method"] == OTHER:
        yield row["member"], row["size"], _other(handle, row, kind)
    else:
        chunks = _read_range(handle, _range_start(handle, row), row["size"])
        yield row["member"], row["size"], _checked(chunks, row)


def each_row(batches):
    """``(open archive, index row)`` for every row; an archive stays open while its rows follow."""
    path, handle = None, None
    try:
        for batch in batches:
            rows = batch.to_pylist()
            for row in sorted(rows, key=lambda r: (r["archive"], r["offset"], r.get("start", 0))):
                if row["archive"] != path:
                    if handle:
                        handle.close()
                    path, handle = row["archive"], _open(row["archive"])
                yield handle, row
    finally:
        if handle:
            handle.close()
        free()


def _resized(chunks, size):
    """Regroup byte chunks to pieces of exactly ``size`` bytes but the last; at least one piece."""
    held = bytearray()
    sent = False
    for chunk in chunks:
        held += chunk
        while len(held) > size:
            yield bytes(held[:size])
            del held[:size]
            sent = True
    if held or not sent:
        yield bytes(held)


def _flushed(rows, schema, weight, most=FLUSH_BYTES):
    """Record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= most or len(held) >= FLUSH_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def read_archive(spark: SparkSession, path: str, kind: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Rows ``(archive, member, size, piece, content, crc, cut)``.

    ``crc`` is the checksum of a cut member that the archive has stored as it is;
    ``whole_members`` tests it, all others are tested as they are read.
    ``piece`` counts from 0. A member of at most ``piece_bytes`` is one row and
    has ``cut`` 0, the pieces of a larger one have ``cut`` 1. Directories, links
    and names that would leave the target folder are not read.
    """
    schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()),
                        ("piece", pa.int32()), ("content", pa.binary()), ("crc", pa.int64())])

    def pieces(batches):
        for handle, row in each_row(batches):
            if row["method"] in (RANGE, STORED):
                length = min(piece_bytes, row["size"] - row["start"])
                chunks = _read_range(handle, _range_start(handle, row) + row["start"], length)
                whole = length == row["size"]
                content = b"".join(_checked(chunks, row) if whole else chunks)
                yield dict(row, content=content, crc=None if whole else row["crc"])
                continue
            for member, size, chunks in members_of(handle, row, kind):
                for number, content in enumerate(_resized(chunks, piece_bytes)):
                    yield {"archive": row["archive"], "member": member, "size": size,
                           "piece": number, "content": content, "crc": None}

    def read(batches):
        return _flushed(pieces(batches), schema, lambda r: len(r["content"]))

    rows = _pieces(member_index(spark, path, kind), piece_bytes).mapInArrow(
        read, "archive string, member string, size bigint, piece int, content binary, crc bigint")
    return rows.withColumn("cut", (F.col("size") > piece_bytes).cast("int"))


def whole_members(df: DataFrame) -> DataFrame:
    """Put members back together: rows ``(archive, member, size, content)``.

    Only cut members are shuffled. A row holds a member whole, so this is for
    members such as messages: one of more than 1 GB raises an error. Land the
    pieces partitioned by ``cut`` first, as the jobs do: either part then reads
    only its own files.
    """
    columns = ["archive", "member", "size", "content"]
    fits = F.when(F.col("size") <= WHOLE_BYTES, F.col("size")).otherwise(F.raise_error(
        F.concat(F.lit("too large to be one row: "), "member")).cast("bigint"))

    def join(key, rows):
        import pandas as pd

        content = b"".join(rows.sort_values("piece")["content"])
        crc = rows["crc"].iloc[0]
        if len(content) != key[2] or (crc == crc and crc is not None and zlib.crc32(content) != int(crc)):
            raise zipfile.BadZipFile(f"bad checksum or size of {key[1]}")
        return pd.DataFrame([(*key, content)], columns=columns)

    cut = (df.where(F.col("cut") == 1).withColumn("size", fits).groupBy("archive", "member", "size")
           .applyInPandas(join, "archive string, member string, size bigint, content binary"))
    return df.where(F.col("cut") == 0).select(*columns).unionByName(cut.select(*columns))


def _blocks(chunks):
    """Regroup byte chunks to blocks of whole lines, of some ``BLOCK_BYTES`` or one line; without the last line end."""
    held = bytearray()
    for chunk in chunks:
        view = memoryview(chunk)
        for at in range(0, len(view), BLOCK_BYTES):
            seen = len(held)
            held += view[at:at + BLOCK_BYTES]
            if len(held) >= BLOCK_BYTES:
                end = held.rfind(b"\n", seen)
                if end >= 0:
                    yield bytes(memoryview(held)[:end])
                    del held[:end + 1]
    if held:
        yield bytes(held.removesuffix(b"\n"))


def _range_of_lines(handle, begin, size, start, length):
    """The bytes of the lines that begin in ``[start, start + length)`` of a member that is a byte range.

    A line is read to its end even beyond the range, and a range inside a line
    gives nothing, so neighbouring ranges hold every line exactly once.
    """
    end = min(start + length, size)
    at = start
    if start > 0:
        # The line under way belongs to an earlier range: skip behind its end.
        at = start - 1
        for chunk in _read_range(handle, begin + at, end - at):
            found = chunk.find(b"\n")
            if found >= 0:
                at += found + 1
                break
            at += len(chunk)
    if at >= end:
        return
    yield from _read_range(handle, begin + at, end - at)
    last = next(_read_range(handle, begin + end - 1, 1))
    if last != b"\n" and end < size:
        for chunk in _read_range(handle, begin + end, size - end):
            found = chunk.find(b"\n")
            if found >= 0:
                yield chunk[:found]
                return
            yield chunk


def read_archive_lines(spark: SparkSession, path: str, kind: str, suffix: str = "",
                       piece_bytes: int = 16 * PIECE_BYTES) -> DataFrame:
    """Rows ``(archive, member, value)``, one per line of the members that end with ``suffix``.

    ``value`` is NULL for a line that is not UTF-8. Python hands over blocks of
    whole lines, which Spark splits; only a block that is not UTF-8 is split there.
    """
    schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("block", pa.string())])

    def valid(block):
        try:
            yield block.decode()
        except UnicodeDecodeError:
            for line in block.split(b"\n"):
                try:
                    yield line.decode()
                except UnicodeDecodeError:
                    yield None

    def blocks(batches):
        for handle, row in each_row(batches):
            if row["method"] in (RANGE, STORED):
                found = [(row["member"], _range_of_lines(
                    handle, _range_start(handle, row), row["size"], row["start"], piece_bytes))]
            else:
                found = ((member, chunks) for member, _, chunks in members_of(handle, row, kind) if member.endswith(suffix))
            for member, chunks in found:
                for block in _blocks(chunks):
                    for text in valid(block):
                        yield {"archive": row["archive"], "member": member, "block": text}

    def read(batches):
        return _flushed(blocks(batches), schema, lambda r: len(r["block"] or ""), BLOCK_BYTES)

    index = member_index(spark, path, kind)
    index = index.where(F.col("member").isNull() | F.col("member").endswith(suffix))
    rows = _pieces(index, piece_bytes).mapInArrow(read, "archive string, member string, block string")
    lines = F.transform(F.split("block", "\n", -1), lambda line: F.when(
        F.endswith(line, F.lit("\r")), F.left(line, F.length(line) - 1)).otherwise(line))
    return rows.select("archive", "member", F.explode_outer(lines).alias("value"))
