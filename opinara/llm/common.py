"""What the operators share: reading, materialising, global order, components."""

import pickle
import uuid
import zlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: cuts lineage and survives lost executors.

    The shuffle files of the write are dropped once it is done, as nothing reads them again.
    """
    spark = df.sparkSession
    folder = work_folder(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(folder)
    out.work_folder = folder
    return out


def discard(*written: DataFrame) -> None:
    """Delete tables of ``materialise`` from which nothing is to be read any more."""
    for df in written:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.work_folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def names_for(df: DataFrame, *wanted: str) -> list[str]:
    """Column names close to ``wanted`` that no column of ``df`` has, whatever its letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def free_of(df: DataFrame, *wanted: str) -> DataFrame:
    """Rename columns that clash with output columns to ``<name>_in``; no column is lost."""
    taken = {w.lower() for w in wanted}
    for c in df.columns:
        if c.lower() in taken:
            df = df.withColumnRenamed(c, names_for(df, f"{c}_in")[0])
    return df


def numbered(df: DataFrame, order: list[str], sizes: list[str], name: str) -> DataFrame:
    """Add, for each column of ``sizes``, its running total before the row in the total order ``order``.

    The rows are range-partitioned and sorted by Spark and written once; each
    range then needs only the totals of the ranges before it, one row a range.
    No task sees more than one range. Totals are named ``<size>_before``.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(n, *order).withColumn("range_no", F.spark_partition_id())
    ranged = materialise(ranged, name)
    totals = ranged.groupBy("range_no").agg(*[F.sum(s).alias(s) for s in sizes])
    # One row a range: as many as there are shuffle partitions.
    ahead = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("range_no", *[F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(f"{s}_base") for s in sizes])
    w = Window.partitionBy("range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(before), "range_no")
    for s in sizes:
        out = out.withColumn(f"{s}_before", F.col(f"{s}_base") + F.coalesce(F.sum(s).over(w), F.lit(0)))
    return out.drop("range_no", *[f"{s}_base" for s in sizes])


class Shared:
    """A value for all tasks, sent compressed and opened once a worker."""

    def __init__(self, spark: SparkSession, value):
        self.name = uuid.uuid4().hex
        self.sent = spark.sparkContext.broadcast(zlib.compress(pickle.dumps(value, protocol=5), 1))

    @property
    def value(self):
        if self.name not in _opened:
            drop_others()
            while len(_opened) >= 3:
                _opened.pop(next(iter(_opened)))
            _opened[self.name] = pickle.loads(zlib.decompress(self.sent.value))
        return _opened[self.name]


_opened = {}
_others = []


def kept_apart(cache: dict) -> dict:
    """A cache of an operator that shares nothing with the others: emptied in a worker that goes on with one of them."""
    _others.append(cache)
    return cache


def drop_others():
    """Empty the caches of ``kept_apart``; a worker outlives its tasks, and so would they."""
    for cache in _others:
        cache.clear()


def forget():
    """Drop what this worker has opened for earlier operators; what is asked for again is opened again."""
    _opened.clear()
    drop_others()


BITMAP, BITMAPS = 32768, 1024  # a filter of 4 MB at any size


def possibly_in(df: DataFrame, key, keys: DataFrame, name: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``keys.name``: a Bloom filter of one probe, as broadcast bitmaps.

    Keeps every row whose key is there, and the more others the more keys there
    are; an exact join follows. Its use is that few rows shuffle for that join.
    """
    def cell(column):
        whole = F.pmod(F.xxhash64(column), F.lit(BITMAP * BITMAPS))
        return F.floor(whole / BITMAP), whole % BITMAP

    part, bit = cell(F.col(name))
    maps = (keys.select(part.alias("part"), bit.alias("bit")).groupBy("part")
            .agg(F.bitmap_construct_agg("bit").alias("bits")))
    c_part, c_bit, c_bits = names_for(df, "filter_part", "filter_bit", "filter_bits")
    part, bit = cell(key)
    asked = (df.withColumn(c_part, part).withColumn(c_bit, bit)
             .join(F.broadcast(maps.toDF(c_part, c_bits)), c_part))
    byte = F.conv(F.hex(F.substring(c_bits, F.floor(F.col(c_bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return asked.where(F.getbit(byte, (F.col(c_bit) % 8).cast("int")) == 1).select(df.columns)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Smallest reachable node of every node of ``edges`` (a, b): rows ``(node, root)``.

    Alternates the two star steps of Kiveris et al. (2014): every node links its
    larger neighbours, then its smaller ones, to the smallest. Minimum and join
    replace lists of neighbours, so a node with very many links is split by
    adaptive execution. Each step is written, and only a count and a checksum
    reach the driver.
    """
    def state(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())

    def star(e, neighbours):
        least = neighbours.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return neighbours.join(least, "u"), least

    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, name)
    seen = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large, _ = star(edges, both)
        large = large.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small, least = star(large, down)
        small = (small.select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a != b").distinct())
        edges = materialise(small, name)
        now = state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
