"""Build archives out of table rows, one per task."""

import io
import tarfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame

from ..sources.archives import filesystem, free


MEMBER_BYTES = 1 << 20
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500  # rows that a worker holds at once


def write_archives(df: DataFrame, folder: str, kind: str) -> None:
    """Write rows ``(member, content)`` to archives below ``folder``."""
    def members(batches):
        for batch in batches:
            for member, content in zip(batch.column("member"), batch.column("content")):
                yield member.as_py(), content.as_py()

    _write(df.select("member", "content"), folder, kind, members)


def write_line_archives(df: DataFrame, folder: str, kind: str) -> None:
    """Write rows ``(entity, value)`` as lines of members of bounded size."""
    def members(batches):
        from pyspark import TaskContext

        task, number, held = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            # Line by line: the batch as Python strings would be several times as large.
            for entity, value in zip(batch.column("entity"), batch.column("value").cast(pa.binary())):
                entity = entity.as_py()
                lines = held.setdefault(entity, bytearray())
                lines += value.as_buffer()
                lines += b"\n"
                if len(lines) >= MEMBER_BYTES:
                    yield f"set-{task}-{number}_{entity}.json", bytes(held.pop(entity))
                    number += 1
        for entity, lines in held.items():
            yield f"set-{task}-{number}_{entity}.json", bytes(lines)

    _write(df.select("entity", "value"), folder, kind, members)


def _write(df, folder, kind, members):
    """One archive per task. ``kind`` is ``zip``, ``tar`` or ``tar.gz``.

    A finished archive is moved into place, so a repeated task leaves no broken file.
    """
    def write(batches):
        from pyspark import TaskContext

        files, path = filesystem(folder)
        files.create_dir(path, recursive=True)
        final = f"{path}/part-{TaskContext.get().partitionId():05d}.{kind}"
        partial = f"{path}/.{uuid.uuid4().hex}"
        n = 0
        with files.open_output_stream(partial) as out:
            archive = (zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) if kind == "zip"
                       else tarfile.open(fileobj=out, mode="w|gz" if kind == "tar.gz" else "w|"))
            with archive:
                for name, content in members(batches):
                    n += 1
                    if kind == "zip":
                        archive.writestr(name, content)
                    else:
                        info = tarfile.TarInfo(name)
                        info.size = len(content)
                        archive.addfile(info, io.BytesIO(content))
                        archive.members = []  # it would keep them all
        files.move(partial, final)
        free()
        yield pa.RecordBatch.from_pydict({"n": [n]})

    conf = df.sparkSession.conf
    before = conf.get(BATCH)
    conf.set(BATCH, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        df.mapInArrow(write, "n bigint").write.format("noop").mode("overwrite").save()
    finally:
        conf.set(BATCH, before)
