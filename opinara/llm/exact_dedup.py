"""Exact dedup with a two-pass Bloom filter, in DataFrame functions only (op 1).

The first pass counts the cells of a Bloom filter that the hash of each text
touches. Cells touched twice or more make a filter of possible repeats, a table
of bitmaps of bounded size. The second pass asks it: a row of which some cell was
touched once has no equal and passes straight through. The other rows shuffle by
their full digest and are settled exactly.
"""

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_of, names_for

BITMAP = 32768  # bits of a bitmap that bitmap_construct_agg makes
CELLS_PER_ROW = 16
MAX_BITMAPS = 16384  # 64 MB: the most that is broadcast
PROBES = 2


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and nothing else changed.

    ``lower`` does it unless the text has capitals beyond ASCII, which it would
    change too; only such a text is translated letter by letter.
    """
    plain = F.octet_length(text) == F.length(text)
    other = text.rlike(r"[^\x00-\x7F&&[\p{IsUppercase}\p{Lt}]]")
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain | ~other, F.lower(text)).otherwise(slow)


def bitmaps_for(rows: int) -> int:
    """Bitmaps of the filter: 16 cells a row up to the bound, beyond which more rows pass for repeats."""
    return max(1, min(MAX_BITMAPS, -(-rows * CELLS_PER_ROW // BITMAP)))


def _cells(digest: Column, bitmaps: int):
    """The bitmap of a digest, and its cells in it."""
    bitmap = F.pmod(F.xxhash64(digest), F.lit(bitmaps))
    return bitmap, [F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(BITMAP)).cast("int") for i in range(1, PROBES + 1)]


def repeats_filter(digests: DataFrame, digest: str, bitmaps: int) -> DataFrame:
    """First pass: bitmaps ``(bitmap, cells)`` of the cells that two digests or more have touched."""
    bitmap, cells = _cells(F.col(digest), bitmaps)
    # A digest counts once in a cell even where both its probes fall there.
    touched = digests.select(bitmap.alias("bitmap"), F.explode(F.array_distinct(F.array(*cells))).alias("cell"))
    twice = touched.groupBy("bitmap", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy("bitmap").agg(F.bitmap_construct_agg(F.col("cell").cast("bigint")).alias("cells"))


def _has(cells: Column, cell: Column) -> Column:
    byte = F.conv(F.hex(F.substring(cells, F.floor(cell / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, cell % 8) == 1


def exact_dedup(df: DataFrame, id="doc_id", text="text") -> DataFrame:
    """Add ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` to every row.

    Texts are equal when they are the same after A-Z become a-z; null counts as
    empty. The row with the largest id of equal texts stays. Rows that repeat both
    id and text are all kept or all dropped; a null id stays only in a group
    without any other id. A hot text is counted before it shuffles, and its rows
    meet one group row in a join that adaptive execution splits. An empty table
    gives no rows. Columns named like the new ones become ``<name>_in``.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    if {id.lower(), text.lower()} & set(added):
        raise ValueError("the id and text columns may not be named like the new ones")
    df = free_of(df, *added)
    bitmap, cells, group, top, size = names_for(df, "bitmap", "cells", "group_key", "top_id", "group_rows")
    df = df.withColumn("text_sha256", F.sha2(lower_ascii(F.coalesce(F.col(text), F.lit(""))).cast("binary"), 256))
    bitmaps = bitmaps_for(df.count())
    own, probes = _cells(F.col("text_sha256"), bitmaps)
    repeats = repeats_filter(df.select("text_sha256"), "text_sha256", bitmaps).select(
        F.col("bitmap").alias(bitmap), F.col("cells").alias(cells))
    asked = df.withColumn(bitmap, own).join(F.broadcast(repeats), bitmap, "left")
    hit = F.col(cells).isNotNull()
    for probe in probes:
        hit = hit & _has(F.col(cells), probe)
    asked = asked.withColumn(group, F.coalesce(hit, F.lit(False))).drop(bitmap, cells)
    through = (asked.where(~F.col(group)).drop(group)
               .withColumn("keep_id", F.col(id)).withColumn("group_size", F.lit(1).cast("bigint"))
               .withColumn("kept", F.lit(True)))
    asked = asked.where(F.col(group)).drop(group)
    groups = asked.groupBy(F.col("text_sha256").alias(group)).agg(
        F.max(id).alias(top), F.count(F.lit(1)).alias(size))
    settled = (asked.join(groups.hint("merge"), F.col("text_sha256") == F.col(group))
               .withColumn("keep_id", F.col(top)).withColumn("group_size", F.col(size))
               .withColumn("kept", F.col(id).eqNullSafe(F.col(top))).drop(group, top, size))
    return through.unionByName(settled)
