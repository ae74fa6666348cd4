"""How the sources of a language differ in their terms, by one-hot level products (op 11).

Within a language every (group, count level) is an indicator column over the kept
terms: 1 where the group holds the term that often. The product of the columns
of two groups, transposed, by each other is their joint table: how many terms
stand at which two levels. Shares depend on the level alone, so the distance of two
groups is the sum of their joint table times the difference of the two levels' shares.

The product is made in blocks. Rows are blocks of some ``BLOCK`` terms, dealt by hash;
columns are tiles of ``TILE`` groups, and each two tiles of a block meet in one
Spark group, so a task holds one block of two tiles at most, and a hot source is
spread over all blocks. There the columns are cut to ``COLUMNS`` at a time and multiplied
as floats of 32 bits, which are exact for counts of so few rows. A block prices its own
part of the joint tables, as prices add up over blocks; only sums of whole numbers
leave it.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

LEAST_DOCUMENTS = 30
PRIOR = 5
SCALE = 1_000_000_000
TERMS_SHOWN = 50
BLOCK, TILE, COLUMNS = 1024, 64, 1024
HELD = 200_000  # counts that a task holds before it sends them on
COUNTED = "lang string, source string, term string, n bigint, docs bigint"
SUMS = "lang string, a string, b string, value bigint"

# Of every byte: a small letter, a byte of a character beyond ASCII, or a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count(batches):
    """Occurrences and documents of each term by group, added up in pieces; a group counts itself under the term ''."""
    from collections import Counter

    import pyarrow as pa

    n, docs, held = {}, {}, 0

    def rows():
        for (lang, source), counts in n.items():
            own, k = docs[lang, source], len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()),
                 pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64()),
                 pa.array([own[term] for term in counts], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for text, lang, source in zip(*(batch.column(c) for c in ("text", "lang", "source"))):
            group = lang.as_py(), source.as_py()
            if group not in n:
                n[group], docs[group] = Counter({b"": 0}), Counter()
            words = Counter((text.as_py() or b"").translate(LETTERS).split())
            held -= len(n[group])
            n[group].update(words)
            docs[group].update(words.keys())
            held += len(n[group])
            if held > HELD:
                yield from rows()
                n, docs, held = {}, {}, 0
    yield from rows()


def term_counts(df: DataFrame, text="text", lang="lang", source="source") -> DataFrame:
    """``(lang, source, term, n, docs)`` of all texts; every group also has the term ''."""
    texts = df.select(F.col(text).cast("binary").alias("text"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))])
    parts = texts.mapInArrow(_count, COUNTED)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n, total, terms):
    """The price of ``n`` occurrences; in decimals, so that no count is too large."""
    whole = "decimal(20,0)"
    return F.expr(f"1 + (cast({SCALE} as {whole}) * (cast({n} as {whole}) + {PRIOR})) div (cast({total} as {whole}) + {PRIOR} * cast({terms} as {whole}))")


def _pieces(rows):
    """Runs of rows whose columns stay within ``COLUMNS``: ``(first, last)``; a single row always fits."""
    open_ = [(0, len(rows))]
    while open_:
        a, b = open_.pop()
        if b - a > 1 and sum(len(np.unique(c)) for c in rows[a:b].T) > COLUMNS:
            open_ += [((a + b) // 2, b), (a, (a + b) // 2)]
        else:
            yield a, b


def _one_hot(levels):
    """Indicator columns of the levels of each group: ``(matrix, column -> group, column -> level)``."""
    found = [np.unique(column, return_inverse=True) for column in levels.T]
    sizes = np.array([len(values) for values, _ in found])
    first = np.r_[0, np.cumsum(sizes)[:-1]]
    matrix = np.zeros((len(levels), sizes.sum()), dtype=np.float32)
    for (_, place), start in zip(found, first):
        matrix[np.arange(len(levels)), start + place] = 1
    return matrix, first, np.concatenate([values for values, _ in found])


def joint_prices(left, right):
    """For each two groups the summed difference of their prices over the rows.

    ``left`` and ``right`` are terms x groups, holding the price of the group's level;
    equal levels of a group have equal prices, so prices stand for levels here.
    """
    total = np.zeros((left.shape[1], right.shape[1]), dtype=np.int64)
    both = np.concatenate([left, right], axis=1)
    for a, b in _pieces(both):
        x, first_x, price_x = _one_hot(left[a:b])
        y, first_y, price_y = (x, first_x, price_x) if right is left else _one_hot(right[a:b])
        tables = (x.T @ y).astype(np.int64)  # the joint tables of all pairs of groups, side by side
        tables *= np.abs(price_x[:, None] - price_y[None, :])
        total += np.add.reduceat(np.add.reduceat(tables, first_x, axis=0), first_y, axis=1)
    return total


def _block(rows):
    """One block of two tiles: every group has a row without a term, which holds its price of no occurrence."""
    import pandas as pd

    none = {"lang": [], "a": [], "b": [], "value": []}
    side = {s: rows[rows["side"] == s] for s in (0, 1)}
    terms = pd.factorize(rows["term"])[0]  # -1: no term
    if not (terms >= 0).any():
        return pd.DataFrame(none)
    # Rows of like counts stand together, so that a piece has few levels.
    weight = np.bincount(terms[terms >= 0], weights=rows["price"].to_numpy()[terms >= 0])
    place = np.empty(len(weight), dtype=np.int64)
    place[np.argsort(weight, kind="stable")] = np.arange(len(weight))
    grids, groups = [], []
    for s in (0, 1):
        own, at = side[s], terms[(rows["side"] == s).to_numpy()]
        zero = own[at < 0].sort_values("source")
        names = zero["source"].to_numpy()
        grid = np.tile(zero["price"].to_numpy(dtype=np.int64), (len(weight), 1))
        grid[place[at[at >= 0]], np.searchsorted(names, own["source"].to_numpy()[at >= 0])] = own["price"].to_numpy()[at >= 0]
        grids.append(grid)
        groups.append(names)
    one = len(side[1]) == 0  # a tile with itself
    if one:
        grids[1], groups[1] = grids[0], groups[0]
    total = joint_prices(*grids)
    i, j = np.nonzero(np.triu(np.ones_like(total), 1) if one else np.ones_like(total))
    # Terms of the block that no group of the two tiles holds are priced at the end.
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "a": groups[0][i], "b": groups[1][j], "value": total[i, j], "terms": len(weight)})


def source_divergence(df: DataFrame, text="text", lang="lang", source="source", shown=TERMS_SHOWN) -> DataFrame:
    """Differences between the sources of each language: ``lang, source, part, item, value, rank``.

    Terms are runs of letters (A-Z in small letters) and of characters beyond ASCII;
    a language keeps those in at least 30 of its rows. A group's price of a term is
    ``1 + floor(1e9 (n + 5) / (N + 5 V))`` for ``n`` of its ``N`` occurrences of ``V`` kept
    terms. Part ``pair`` gives for each other source of the language the summed
    difference of all prices; part ``term`` the ``shown`` terms that the group has
    above the price in its whole language, and by how much. Ranks go by falling
    value, then item in byte order.

    Null texts, languages and sources count as ''. Texts are read whole; repeated rows
    count each; ids and other columns play no part, whatever their names. A language
    without kept terms has differences of 0; an empty table gives no rows.
    """
    spark = df.sparkSession
    counts = materialise(term_counts(df, text, lang, source), "terms")
    kept = counts.where("term != ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n")).where(F.col("docs") >= LEAST_DOCUMENTS)
    kept = materialise(kept.select("lang", "term", "all_n"), "kept")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("lang_n"))
    held = materialise(counts.where("term != ''").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all_n"), "held")
    own = held.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = (counts.where("term = ''").select("lang", "source").join(sizes, "lang", "left").join(own, ["lang", "source"], "left")
              .na.fill(0, ["v", "lang_n", "group_n"]))
    # Tiles by the order of the sources; one language has as many as its pairs need anyway.
    order = Window.partitionBy("lang").orderBy("source")
    groups = (groups.withColumn("tile", F.floor((F.row_number().over(order) - 1) / TILE))
              .withColumn("tiles", F.floor((F.count(F.lit(1)).over(Window.partitionBy("lang")) - 1) / TILE) + 1)
              .withColumn("blocks", F.ceil(F.col("v") / BLOCK)))
    groups = materialise(groups, "groups").withColumn("zero", F.when(F.col("v") > 0, _share(0, "group_n", "v")).otherwise(0))

    priced = held.join(groups, ["lang", "source"]).withColumn("price", _share("n", "group_n", "v"))
    entries = priced.select("lang", "source", "tile", "tiles", "term", "price", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"))
    empty = groups.where("v > 0").select(
        "lang", "source", "tile", "tiles", F.lit(None).cast("string").alias("term"), F.col("zero").alias("price"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    rows = entries.unionByName(empty)
    # Tile t meets every tile: as the first of later ones, as the second of earlier ones.
    met = rows.select("lang", "block", "source", "term", "price", "tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("other"))
    met = met.select("lang", "block", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"),
                     (F.col("tile") > F.col("other")).cast("int").alias("side"), "source", "term", "price")
    sums = met.groupBy("lang", "block", "first", "second").applyInPandas(_block, f"{SUMS}, terms bigint")
    sums = materialise(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")), "joint")

    zeros = groups.select("lang", "source", "v", "zero")
    both = (zeros.toDF("lang", "a", "v", "zero_a").join(zeros.select("lang", F.col("source").alias("b"), F.col("zero").alias("zero_b")), "lang")
            .where("a < b").join(sums, ["lang", "a", "b"], "left").na.fill(0, ["value", "terms"]))
    both = both.withColumn("value", F.col("value") + (F.col("v") - F.col("terms")) * F.abs(F.col("zero_a") - F.col("zero_b")))
    pairs = both.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p"), "value")
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (pairs.select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value").withColumn("rank", F.row_number().over(w)))

    above = (priced.withColumn("value", F.col("price") - _share("all_n", "lang_n", "v")).where("value > 0")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value"))
    # A share of a group's terms first: no task sorts all terms of a hot group.
    salted = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(32))).orderBy(F.desc("value"), "item")
    above = above.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= shown).drop("rank")
    terms = above.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= shown)
    return pairs.unionByName(terms)
