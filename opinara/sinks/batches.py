"""Land batches: as a partitioned table, or as the original files.

Every landing of a batch is a version, a folder of its own below the batch's. It
counts once its pointer stands in ``_landed/<batch>``, a small file that appears at once,
by a rename to a new name, and holds the version's columns and number of rows. The
newest pointer of a batch holds; readers follow it and list no other folder.
"""

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources import archives

POINTERS = "_landed"  # Spark's readers pass over names that begin with _


def write_batch(df: DataFrame, root: str, batch: str, also_by=()) -> None:
    """Write rows as partition ``batch`` of the parquet table at ``root``.

    Landing the same batch again replaces all of it, whatever its inner partitions
    were, and an empty landing leaves it empty. Other batches stay as they are. The
    earlier rows hold until the new ones are complete: a landing that fails, at any
    point, leaves them as they were. Then they go, so that a plain read of ``root``
    sees one version of each batch too.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    home, seen = f"{root}/batch={batch}", Observation()
    folder = f"{home}/version={stamp}"
    try:
        (df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
         .partitionBy(*also_by).parquet(folder))
        fields = [f for f in df.schema.fields if f.name not in also_by]
        schema = StructType([*fields, *[df.schema[c] for c in also_by]])
        _publish(spark, f"{root}/{POINTERS}/{batch}", stamp, {"rows": seen.get["rows"], "schema": schema.jsonValue()})
    except Exception:
        _delete(spark, folder)
        raise
    # From here on the new version holds, whatever becomes of the old ones.
    for name in _names(spark, home):
        if name != f"version={stamp}":
            _delete(spark, f"{home}/{name}")
    for name in _names(spark, f"{root}/{POINTERS}/{batch}"):
        if name != stamp:
            _delete(spark, f"{root}/{POINTERS}/{batch}/{name}")


def _store(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark, folder):
    """Names in one folder, in order; none where there is no folder."""
    files, path = _store(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def _delete(spark, path):
    files, path = _store(spark, path)
    files.delete(path, True)


def _publish(spark, folder, name, content):
    """Make a small file appear at once, with all its content."""
    files, partial = _store(spark, f"{folder}/.{name}")
    out = files.create(partial, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if not files.rename(partial, _store(spark, f"{folder}/{name}")[1]):
        raise OSError(f"could not publish {folder}/{name}")


def current_version(spark, root: str, batch: str):
    """Folder, columns and number of rows of what holds for ``batch``; None if it was never landed whole."""
    root = root.rstrip("/")
    stamps = [n for n in _names(spark, f"{root}/{POINTERS}/{batch}") if not n.startswith(".")]
    if not stamps:
        return None
    files, path = _store(spark, f"{root}/{POINTERS}/{batch}/{stamps[-1]}")
    stream = files.open(path)
    told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    return f"{root}/batch={batch}/version={stamps[-1]}", StructType.fromJson(told["schema"]), told["rows"]


def landed_batches(spark, root: str) -> list[str]:
    """Keys of the landed batches, newest first; one folder is listed."""
    return _names(spark, f"{root.rstrip('/')}/{POINTERS}")[::-1]


def newest_landed(spark, root: str) -> str:
    """The newest batch with rows; raises when there is none."""
    for batch in landed_batches(spark, root):
        found = current_version(spark, root, batch)
        if found and found[2]:
            return batch
    raise ValueError("no batch folder found")


def read_batch(spark, root: str, batch: str) -> DataFrame:
    """Rows of one batch as last landed whole; nothing else is listed or read."""
    found = current_version(spark, root, batch)
    if found is None:
        raise ValueError(f"batch {batch} has not been landed")
    folder, schema, _ = found
    parts = StructType([StructField("batch", StringType()), StructField("version", StringType())])
    rows = spark.read.schema(StructType([*schema.fields, *parts.fields])).option("basePath", root).parquet(folder)
    return rows.where(F.col("batch") == batch).drop("version")


def landed_folders(spark, root: str) -> DataFrame:
    """One row per landed file with its partition columns; no file is opened."""
    return spark.read.format("binaryFile").load(root).drop("path", "modificationTime", "length", "content")


def newest_batch(spark, root: str) -> DataFrame:
    """Rows of the newest batch at ``root`` that has any; older ones are neither listed nor read."""
    return read_batch(spark, root, newest_landed(spark, root))


def write_member_files(index: DataFrame, kind: str, root: str, batch: str) -> DataFrame:
    """Write each member to ``<root>/<batch>/<member>``; rows ``(member, size)`` written.

    ``index`` comes from ``archives.member_index``. A task streams its members
    piece by piece to a name of its own and moves the finished file into place,
    so a lost or repeated task leaves no half-written object. The work runs when
    the result is used.
    """
    target = f"{root.rstrip('/')}/{batch}"

    def save(member, chunks):
        files, path = archives.filesystem(f"{target}/{member}")
        folder, _, name = path.rpartition("/")
        files.create_dir(folder, recursive=True)
        partial = f"{folder}/.{name}.{uuid.uuid4().hex}"
        size = 0
        with files.open_output_stream(partial) as out:
            for chunk in chunks:
                out.write(chunk)
                size += len(chunk)
        files.move(partial, path)
        return {"member": member, "size": size}

    def write(batches):
        import pyarrow as pa

        schema = pa.schema([("member", pa.string()), ("size", pa.int64())])
        for handle, row in archives.each_row(batches):
            written = [save(member, chunks)
                       for member, _, chunks in archives.members_of(handle, row, kind)]
            yield pa.RecordBatch.from_pylist(written, schema=schema)

    return archives.spread_members(index).mapInArrow(write, "member string, size bigint")
