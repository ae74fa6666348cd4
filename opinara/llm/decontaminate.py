"""Benchmark decontamination by winnowing, in DataFrame functions only (op 12).

Of every ``GUARANTEE - K + 1`` neighbouring hashes of ``K`` words the least is kept as a
fingerprint. Texts that share ``GUARANTEE`` words in a row share the fingerprint of
that stretch, so no such stretch is missed. An item of fewer words, for which that
does not hold, is looked for by the hash of all its words at every place.

Only the fingerprints that a bounded filter lets through leave the scan, as pairs of
text digest and hash; texts that hold one are fetched once each. There each hit is
extended to the windows around it, and these are compared with the windows of the
items word by word: hashes only choose what is looked at. Equal texts are settled
once, and equal windows of different items are one window, so a common passage
makes one row a text and place, never pairs of texts and items.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vocabulary import let
from .common import BITMAP, BITMAPS, free_of, materialise, names_for, possibly_in
from .exact_dedup import lower_ascii

GUARANTEE, K = 10, 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPANS = "array<struct<start:int,end:int>>"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _grams(words: Column, k: int) -> Column:
    """Hashes of the ``k`` words from each place on where there are so many."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)], F.lit(k)))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0)))


def fingerprints(words: Column) -> Column:
    """The least hash of each ``GUARANTEE - K + 1`` neighbouring ones, without repeats."""
    span = GUARANTEE - K + 1
    return let(_grams(words, K), lambda g: F.array_distinct(F.slice(
        F.transform(g, lambda x, i: F.least(x, *[F.get(g, i + j) for j in range(1, span)])),
        F.lit(1), F.greatest(F.size(g) - (span - 1), F.lit(0)))))


def _item_windows(items: DataFrame) -> DataFrame:
    """``(item, words, window)``: each ``GUARANTEE`` words in a row of an item, or all if fewer."""
    def cut(ws):
        several = F.transform(F.sequence(F.lit(1), F.size(ws) - (GUARANTEE - 1)), lambda i: F.array_join(F.slice(ws, i, GUARANTEE), " "))
        return F.when(F.size(ws) >= GUARANTEE, several).when(F.size(ws) > 0, F.array(F.array_join(ws, " ")))

    return items.select("item", F.least(F.size("words"), F.lit(GUARANTEE)).alias("m"), F.explode(let(F.col("words"), cut)).alias("window")).distinct()


def _asked(words: Column, short: list[int]) -> Column:
    """All hashes by which a text is looked for."""
    return F.concat(fingerprints(words), *[F.array_distinct(_grams(words, m)) for m in short])


def _placed(words: Column, short: list[int]) -> Column:
    """The same hashes with the length they stand for and their place; those of ``K`` words at every place."""
    def of(m, k):
        return F.transform(_grams(words, k), lambda x, i: F.struct(F.lit(m).alias("m"), i.alias("at"), x.alias("hash")))

    return F.concat(of(GUARANTEE, K), *[of(m, m) for m in short])


def _around(words: Column, hits: Column) -> Column:
    """Windows around the hits of a text: ``(m, start, window)``."""
    def starts(h):
        first = F.greatest(h["at"] - (GUARANTEE - K), F.lit(0))
        whole = F.transform(F.sequence(first, F.least(h["at"], F.size(words) - GUARANTEE)), lambda s: F.struct(h["m"].alias("m"), s.alias("start")))
        return F.when(h["m"] == GUARANTEE, F.when(F.size(words) >= GUARANTEE, whole)).otherwise(
            F.array(F.struct(h["m"].alias("m"), h["at"].alias("start"))))

    places = F.array_distinct(F.flatten(F.filter(F.transform(hits, starts), lambda a: a.isNotNull())))
    return F.transform(places, lambda p: F.struct(
        p["m"].alias("m"), p["start"].alias("start"), F.array_join(F.slice(words, p["start"] + 1, p["m"]), " ").alias("window")))


def occurrences(texts: DataFrame, windows: DataFrame, hashes: DataFrame, short: list[int]) -> DataFrame:
    """Places ``(digest, start, end, window)`` at which ``texts`` (digest, text) hold a window."""
    asked = texts.select("digest", F.explode(let(words_of(F.col("text")), lambda ws: _asked(ws, short))).alias("hash"))
    chosen = possibly_in(asked, F.col("hash"), hashes, "hash").join(hashes, "hash", "left_semi").select("digest").distinct()
    chosen = materialise(chosen, "chosen")
    held = possibly_in(texts, F.col("digest"), chosen, "digest").join(chosen, "digest", "left_semi")
    held = materialise(held.groupBy("digest").agg(F.first("text").alias("text")).select("digest", words_of(F.col("text")).alias("words")), "held")
    placed = held.select("digest", F.inline(_placed(F.col("words"), short)))
    hits = possibly_in(placed, F.col("hash"), hashes, "hash").join(hashes, "hash", "left_semi")
    hits = hits.groupBy("digest").agg(F.collect_list(F.struct("m", "at")).alias("hits"))  # no more than the text has places
    around = held.join(hits, "digest").select("digest", F.inline(_around(F.col("words"), F.col("hits"))))
    found = around.join(windows, ["window", "m"], "left_semi")
    return found.select("digest", "start", (F.col("start") + F.col("m")).alias("end"), "window")


def _maybe(df: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Add ``flag``: false only where ``df.key`` is surely not among ``keys.key``; by a broadcast filter of bounded size."""
    def cell(column):
        whole = F.pmod(F.xxhash64(column), F.lit(BITMAP * BITMAPS))
        return F.floor(whole / BITMAP), whole % BITMAP

    part, bit = cell(F.col(key))
    c_part, c_bits = names_for(df, "filter_part", "filter_bits")
    maps = keys.select(part.alias(c_part), bit.alias("bit")).groupBy(c_part).agg(F.bitmap_construct_agg("bit").alias(c_bits))
    joined = df.withColumn(c_part, part).join(F.broadcast(maps), c_part, "left")
    byte = F.conv(F.hex(F.substring(c_bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return joined.withColumn(flag, F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))).drop(c_part, c_bits)


def decontaminate(df: DataFrame, benchmark: DataFrame, text="text", item_id="item_id", item_text="text") -> DataFrame:
    """Add what every row shares with a benchmark: ``n_words, n_hit, n_items, items, spans, contaminated``.

    Words are runs of digits, letters (A-Z in small letters) and characters beyond
    ASCII. An item's windows are its stretches of ten words, or all its words if it
    has fewer. A word of ``df`` within an occurrence of a window is hit: ``n_hit`` counts
    these, ``spans`` holds their runs as word numbers from 0, end exclusive. ``items``
    are the ids of the items with an occurring window, as strings in order.

    Null and empty texts have no words on either side. Repeated rows are judged alike;
    items that repeat an id are one, and hits of an item without an id count, but
    name no item. Texts are used whole. Columns of ``df`` that clash with new ones become
    ``<name>_in``; other columns of the benchmark play no part. An empty table gives no
    rows; an empty benchmark hits nothing.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    items = materialise(items, "items")
    parts = materialise(_item_windows(items), "windows")
    windows = materialise(parts.select("window", "m").distinct(), "distinct")
    short = sorted(r["m"] for r in windows.where(F.col("m") < GUARANTEE).select("m").distinct().collect())  # nine numbers at most
    whole = F.array(*[F.when(F.size("words") == m, F.get(_grams(F.col("words"), m), F.lit(0))) for m in short] or [F.lit(None).cast("bigint")])
    hashes = items.select(F.explode(F.when(F.size("words") >= GUARANTEE, fingerprints(F.col("words"))).otherwise(F.array_compact(whole))).alias("hash"))
    hashes = materialise(hashes.distinct(), "hashes")

    df = free_of(df, "n_words", "n_hit", "n_items", "items", "spans", "contaminated")
    digest, flag = names_for(df, "digest", "looked_at")
    texts = df.where(F.col(text).isNotNull()).select(F.unhex(F.sha2(F.col(text).cast("binary"), 256)).alias("digest"), F.col(text).alias("text"))
    found = materialise(occurrences(texts, windows, hashes, short), "occurrences")

    # One text has no more places than words, so its own are ordered in one task.
    w = Window.partitionBy("digest").orderBy("start", "end")
    runs = found.select("digest", "start", "end").distinct()
    runs = runs.withColumn("before", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    runs = runs.withColumn("run", F.sum((F.col("start") > F.coalesce("before", F.lit(-1))).cast("int")).over(w))
    runs = runs.groupBy("digest", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = runs.groupBy("digest").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    named = found.select("digest", "window").distinct().join(parts.where("item IS NOT NULL").select("window", "item"), "window")
    named = named.select("digest", "item").distinct().groupBy("digest").agg(F.sort_array(F.collect_list("item")).alias("items"))
    told = materialise(runs.join(named, "digest", "left"), "told").withColumnRenamed("digest", digest)

    rows = df.withColumn(digest, F.unhex(F.sha2(F.col(text).cast("binary"), 256)))
    rows = rows.withColumn("n_words", F.coalesce(F.regexp_count(text, F.lit(ANY_CASE)), F.lit(0)).cast("bigint"))
    rows = _maybe(rows, told, digest, flag)
    # Rows that nothing was found in pass straight through; the others meet their text's result.
    clear = rows.where(~F.col(flag)).withColumns({"n_hit": F.lit(None).cast("bigint"), "spans": F.lit(None).cast(SPANS), "items": F.lit(None).cast("array<string>")})
    hit = rows.where(flag).join(told, digest, "left")
    out = hit.unionByName(clear)
    return out.select(*df.columns, "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.coalesce("spans", F.array().cast(SPANS)).alias("spans"), F.col("n_hit").isNotNull().alias("contaminated"))
