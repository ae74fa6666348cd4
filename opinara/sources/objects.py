"""Object listings, batch choice and path filters."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batch import KEY_PATTERN
from .archives import filesystem


LISTED = "path string, name string, length bigint"
FLUSH_BYTES, FLUSH_NAMES = 8 << 20, 10_000
READ_TASK_BYTES = 128 << 20


def _list_folders(files, root, deep):
    """Objects below the folders ``name`` of ``root``; without ``deep`` also the folders, with length -1."""
    from pyarrow import fs

    def listed(batches):
        import pyarrow as pa

        store, base = filesystem(root)
        base = base.rstrip("/")
        for batch in batches:
            for folder in batch.column("name").to_pylist():
                selector = fs.FileSelector(f"{base}/{folder}".rstrip("/"), recursive=deep, allow_not_found=True)
                found = [i for i in store.get_file_info(selector) if i.is_file or not deep]
                for k in range(0, len(found), FLUSH_NAMES):
                    some = found[k:k + FLUSH_NAMES]
                    names = [i.path[len(base) + 1:] for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{root}/{n}" for n in names], pa.string()), pa.array(names, pa.string()),
                         pa.array([i.size if i.is_file else -1 for i in some], pa.int64())], names=["path", "name", "length"])

    return files.select("name").mapInArrow(listed, LISTED)


def list_objects(spark: SparkSession, root: str, prefix: str = "", content=False) -> DataFrame:
    """One row ``(path, name, length[, content])`` per object below ``root`` whose name begins with ``prefix``.

    ``name`` is the path relative to ``root``. Every object counts, also an empty
    one and one whose name begins with ``_`` or ``.``, which Spark's own readers
    leave out. Only the folder that ``prefix`` names is listed, and the folders in it
    by a task each; no object elsewhere is opened. File bytes are read only when
    ``content`` is asked for.
    """
    root = root.rstrip("/")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    start = spark.createDataFrame([(prefix.rpartition("/")[0],)], "name string")
    top = _list_folders(start, root, deep=False).where(F.startswith("name", F.lit(prefix)))
    folders = top.where("length < 0").repartition(tasks, "name")
    found = top.where("length >= 0").union(_list_folders(folders, root, deep=True))
    if not content:
        return found
    return read_objects(found, tasks)


def newest_folder(spark: SparkSession, root: str) -> str:
    """The newest batch key among the folders right below ``root`` that hold an object; raises when there is none.

    Only ``root`` itself is listed, and then the newest folder: what older batches
    hold is not looked at.
    """
    root = root.rstrip("/")
    top = _list_folders(spark.createDataFrame([("",)], "name string"), root, deep=False)
    keys = top.where((F.col("length") < 0) & F.col("name").rlike(rf"\A{KEY_PATTERN}\z")).select("name").collect()  # one a batch
    for key in sorted((r["name"] for r in keys), reverse=True):
        if not list_objects(spark, root, f"{key}/").isEmpty():
            return key
    raise ValueError("no batch folder found")


def read_objects(found: DataFrame, tasks: int) -> DataFrame:
    """Add the bytes of every listed object."""
    size = found.agg(F.sum("length")).first()[0] or 0

    def read(batches):
        import pyarrow as pa

        schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("length", pa.int64()), ("content", pa.binary())])
        held, weight = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                store, path = filesystem(row["path"])
                with store.open_input_file(path) as stream:
                    held.append(dict(row, content=stream.read()))
                weight += row["length"]
                if weight >= FLUSH_BYTES or len(held) >= 2000:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, weight = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    spread = found.repartition(max(tasks, -(-size // READ_TASK_BYTES)), "name")
    return spread.mapInArrow(read, f"{LISTED}, content binary")


def batch_of(name: Column) -> Column:
    """First path segment, NULL when it is no batch key or the name has no folder."""
    return F.nullif(F.regexp_extract(name, rf"\A({KEY_PATTERN})/", 1), F.lit(""))


def batches(df: DataFrame, name="name") -> DataFrame:
    """The distinct batch keys, newest first."""
    return (df.select(batch_of(F.col(name)).alias("batch")).where(F.col("batch").isNotNull())
            .distinct().orderBy(F.desc("batch")))


def latest_batch(df: DataFrame, name="name") -> DataFrame:
    """Objects of the newest batch. One value is broadcast; nothing is collected."""
    keyed = df.withColumn("batch", batch_of(F.col(name)))
    newest = keyed.agg(F.max("batch").alias("batch"))
    return keyed.join(F.broadcast(newest), "batch")


def newest_batch_key(df: DataFrame, column="batch") -> str:
    """The newest key as a value, for jobs; raises when there is no batch."""
    key = df.agg(F.max(column)).first()[0]
    if key is None:
        raise ValueError("no batch folder found")
    return key


def select_paths(df: DataFrame, folder="", suffix="", containing="", name="name") -> DataFrame:
    """Names inside ``<batch>/<folder>/`` that end with ``suffix`` and hold ``containing``."""
    inner = F.substring_index(F.col(name), "/", -1)
    kept = F.col(name).endswith(suffix) & F.col(name).contains(containing)
    if folder:
        after = F.substr(F.col(name), F.instr(F.col(name), "/") + 1)
        kept = kept & after.startswith(folder.rstrip("/") + "/")
    return df.where(kept & (inner != ""))


def entity_name(name: Column) -> Column:
    """``<batch>/data_set_review.json`` -> ``review``."""
    file = F.substring_index(name, "/", -1)
    return F.substring_index(F.split_part(file, F.lit("."), F.lit(1)), "_", -1)
