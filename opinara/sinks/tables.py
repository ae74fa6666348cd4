"""Replace tables, refresh views, keep a load audit."""

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

OWNER = "opinara.made_by"
AUDIT_SCHEMA = "table string, started timestamp, ended timestamp, duration interval day to second, rows bigint"


def _stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")  # 20 digits


def drop_with_files(spark, name: str) -> None:
    """Drop a table of this module's making together with its files, wherever they lie."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for row in rows:
        _delete(spark, row["data_type"])


def _delete(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _write_table(df, name, path, fmt, partition_by, bucket_by, buckets, options):
    writer = df.write.format(fmt).mode("errorifexists").options(**options)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def replace_table(df: DataFrame, name: str, path: str = None, fmt="parquet",
                  partition_by=None, bucket_by=None, buckets=None, clustered=False, **options) -> None:
    """Write ``df`` as table ``name`` in place of what was there.

    The rows are written beside the old table, which takes the name over only when
    they are complete: a write that fails leaves the old table as it was. With
    ``path`` each version has a folder of its own below it. The old version goes
    with its files if this function made it; of any other table the files stay.

    Tables that will be joined on ``bucket_by`` should share ``buckets``: they
    then meet bucket by bucket, without a shuffle. Rows are brought together by
    bucket before the write, so that not every task adds a file to every bucket;
    adaptive execution splits a bucket that a hot key has made too large.
    ``clustered`` says that the rows come from a table of the same buckets.
    """
    spark = df.sparkSession
    if bucket_by and not clustered:
        df = df.hint("rebalance", bucket_by)
    stamp = _stamp()
    fresh, old = f"{name}_new{stamp}", f"{name}_old{stamp}"
    folder = f"{path.rstrip('/')}/{stamp}" if path else None
    try:
        _write_table(df, fresh, folder, fmt, partition_by, bucket_by, buckets, options)
    except Exception:
        if spark.catalog.tableExists(fresh):
            drop_with_files(spark, fresh)
        elif folder:
            _delete(spark, folder)
        raise
    spark.sql(f"ALTER TABLE {fresh} SET TBLPROPERTIES ('{OWNER}' = 'replace_table')")
    exists = spark.catalog.tableExists(name)
    _swap(spark, name, fresh, old if exists else None)
    if exists:
        if _owner(spark, old) == "replace_table":
            drop_with_files(spark, old)
        else:
            spark.sql(f"DROP TABLE {old}")


def _rename(spark, name, to):
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")


def _swap(spark, name, fresh, old):
    """Give ``name`` to table ``fresh``, and ``old`` to the table that had it.

    If the second rename fails, the first is undone and ``fresh`` goes: the table is
    again what it was. Should even that fail, the error tells under which name its rows are.
    """
    try:
        if old:
            _rename(spark, name, old)
    except Exception:
        drop_with_files(spark, fresh)
        raise
    try:
        _rename(spark, fresh, name)
    except Exception as error:
        if old:
            try:
                _rename(spark, old, name)
            except Exception:
                raise RuntimeError(f"{name} could not be replaced; its rows are in {old}, the new ones in {fresh}") from error
        drop_with_files(spark, fresh)
        raise


def _owner(spark, name):
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == OWNER).collect()
    return rows[0]["value"] if rows else None


def save_external(df: DataFrame, fmt: str, mode="overwrite", **options) -> None:
    """Write through any connector, such as a warehouse's."""
    df.write.format(fmt).mode(mode).options(**options).save()


def create_table_as(df: DataFrame, name: str, columns=None, **options) -> None:
    """Copy all or some columns into a table of Spark's own format."""
    replace_table(df.select(*columns) if columns else df, name, **options)


def refresh_view(df: DataFrame, name: str, path: str = None, **options) -> None:
    """Store ``df`` beside the current version, then point view ``name`` at it.

    Readers see the old rows or the new ones, never a half-written table. The
    version before the current one stays for readers under way; older ones are
    dropped with their files. Only tables that this function made for this very
    view are ever dropped: their names are the view's with 20 digits, and they
    carry its name as a property.
    """
    spark = df.sparkSession
    database, _, short = name.rpartition(".")
    dot = f"{database}." if database else ""
    stored = f"{name}_v{_stamp()}"
    _write_table(df, stored, f"{path.rstrip('/')}/{stored.rpartition('.')[2]}" if path else None, options.pop("fmt", "parquet"),
                 None, None, None, options)
    spark.sql(f"ALTER TABLE {stored} SET TBLPROPERTIES ('{OWNER}' = 'refresh_view {short}')")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {stored}")
    tables = [t.name for t in spark.catalog.listTables(database or None) if re.fullmatch(re.escape(short) + r"_v[0-9]{20}", t.name)]
    versions = sorted(t for t in tables if _owner(spark, dot + t) == f"refresh_view {short}")
    for older in versions[:-2]:
        drop_with_files(spark, dot + older)


def content_sum(schema) -> Column:
    """Checksum of a frame's rows as one aggregate: equal for equal rows in any order and any number of tasks.

    Two sums of 64-bit hashes over all columns, by name. Repeated rows count each, and a
    missing value differs from an empty one. Unequal contents agree by chance only, about
    once in 2^128; it is no seal against forgery.
    """
    def plain(field):
        column = F.col(f"`{field.name}`")
        # Hashes take no maps and no variants.
        return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() or "variant" in field.dataType.simpleString() else column

    fields = sorted(schema.fields, key=lambda f: f.name)
    values = [v for f in fields for v in (F.lit(f.name), F.col(f"`{f.name}`").isNull(), plain(f))]
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)")), F.lit(0)).cast("string") for seed in (1, 2)]
    return F.concat_ws(":", *sums)


def content_of(df: DataFrame) -> str:
    """The checksum of what a frame holds, to be told equal to that of a load's audit."""
    return df.agg(content_sum(df.schema).alias("content")).first()[0]


def audited(df: DataFrame, table: str, write, clock=lambda: datetime.now(timezone.utc), content=False) -> DataFrame:
    """Run ``write(df)`` and return one audit row; rows are counted by the write itself.

    With ``content`` the write also sums up what it wrote, as column ``content``: an
    archive, its landing and a table can so be told equal without reading them again.
    """
    spark = df.sparkSession
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *([content_sum(df.schema).alias("content")] if content else [])]
    started = clock()
    write(df.observe(seen, *metrics))
    ended = clock()
    row = (table, started, ended, ended - started, seen.get["rows"], *([seen.get["content"]] if content else []))
    return spark.createDataFrame([row], AUDIT_SCHEMA + (", content string" if content else ""))
