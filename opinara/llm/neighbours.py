"""Approximate nearest neighbours by inner product along shifted Hilbert curves (op 10).

Vectors are brought to a sphere, on which the largest inner product is the nearest,
and projected to a few random directions. A Hilbert curve through each of several
shifted and turned projections gives an order, which Spark range-partitions. A
query meets the vectors that stand near it in any of the orders, and the best by
exact inner product stay. How near is near enough is measured: the window grows
until a sample of queries finds its true neighbours.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, numbered

CURVES = 4
DIRECTIONS = 8
BITS = 7
BLOCK = 2048  # rows that are compared at once
STRIPE = 16  # neighbouring blocks of a task, of which a query keeps the best only
WINDOW = 1024  # rows on either side of a query, to begin with
SAMPLE = 128  # queries whose true neighbours are found to measure recall
RECALL = 0.94  # of the sample; its error leaves 0.9 for all
SEED = 7


def hilbert(points, bits):
    """Place on a Hilbert curve of integer points, by the transposition of Skilling (2004)."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(len(x)):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        bit >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn, bit = np.zeros(len(points), dtype=np.int64), 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where(x[-1] & bit, bit - 1, 0)
        bit >>= 1
    key = np.zeros(len(points), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> b) & 1)
    return key


def _matrix(column, dim):
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


class Curves:
    """The orders: a projection, a shift and a scale for each."""

    def __init__(self, dim, longest):
        rng = np.random.default_rng(SEED)
        self.dim, self.longest = dim, longest
        self.axes = [np.linalg.qr(rng.normal(size=(dim + 1, min(DIRECTIONS, dim + 1))))[0] for _ in range(CURVES)]
        self.shifts = [rng.uniform(-0.5, 0.5, axes.shape[1]) for axes in self.axes]
        self.mean = self.spread = None

    def projected(self, vectors):
        """A vector as it stands on the sphere of the longest one, in each projection."""
        x = vectors / self.longest
        lift = np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))
        return [np.c_[x, lift] @ axes for axes in self.axes]

    def keys(self, vectors):
        top = (1 << BITS) - 1
        for z, mean, spread, shift in zip(self.projected(vectors), self.mean, self.spread, self.shifts):
            unit = ((z - mean) / spread + shift + 3.5) / 7  # 3 spreads either way; what is beyond stands at the rim
            yield hilbert(np.clip((unit * (top + 1)).astype(np.int64), 0, top), BITS)


def _fit(classes, curves):
    """Mean and spread of every projected direction: a fixed number of sums."""
    def measure(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                z = np.concatenate(curves.projected(_matrix(batch.column("vector"), curves.dim)), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(z.shape[1])), pa.array(z.sum(axis=0)), pa.array((z * z).sum(axis=0)), pa.array([len(z)] * z.shape[1])],
                    names=["i", "s", "q", "n"])

    sums = (classes.select("vector").mapInArrow(measure, "i bigint, s double, q double, n bigint")
            .groupBy("i").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("n").alias("n")).orderBy("i").collect())
    s, q, n = (np.array([row[c] for row in sums], dtype=np.float64) for c in ("s", "q", "n"))
    mean = s / n
    spread = np.sqrt(np.maximum(q / n - mean * mean, 0))
    spread[spread < 1e-12] = 1
    edges = np.cumsum([axes.shape[1] for axes in curves.axes])[:-1]
    curves.mean, curves.spread = np.split(mean, edges), np.split(spread, edges)
    return curves


def ordered(classes: DataFrame, curves: Curves) -> DataFrame:
    """Every class once per curve, ``(curve, c, least, asks, vector, place)`` with its place among all."""
    def key(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                for curve, keys in enumerate(curves.keys(_matrix(batch.column("vector"), curves.dim))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([curve] * batch.num_rows, pa.int32()), pa.array(keys), *(batch.column(c) for c in ("c", "least", "asks", "vector"))],
                        names=["curve", "key", "c", "least", "asks", "vector"])

    kind = classes.schema["vector"].dataType.simpleString()
    least = classes.schema["least"].dataType.simpleString()
    rows = classes.select("c", "least", "asks", "vector").mapInArrow(
        key, f"curve int, key bigint, c bigint, least {least}, asks boolean, vector {kind}")
    placed = numbered(rows.withColumn("one", F.lit(1).cast("bigint")), ["curve", "key", "c"], ["one"], "curves")
    return placed.select("c", "least", "asks", "vector", F.col("one_before").alias("place"))


FOUND = "query bigint, c bigint, least {least}, score double"


def best(queries, numbers, vectors, ids, least, k):
    """The ``k`` best vectors of each query by product, ties to the smaller ``least``: ``(query, row)`` pairs with scores."""
    out = []
    for a in range(0, len(queries), 512):
        q = queries[a:a + 512]
        products = q @ vectors.T
        if products.shape[1] > k:
            # All that reach the k-th product; equal ones are told apart below.
            edge = np.partition(products, products.shape[1] - k, axis=1)[:, products.shape[1] - k]
            i, j = np.nonzero(products >= edge[:, None] - 1e-12 * np.abs(edge[:, None]))
        else:
            i, j = (x.ravel() for x in np.indices(products.shape))
        exact = np.einsum("ij,ij->i", q[i], vectors[j])
        order = np.lexsort((least[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < k
        out.append((numbers[a:a + 512][i[keep]], ids[j[keep]], least[j[keep]], exact[keep]))
    return [np.concatenate(x) for x in zip(*out)]


def _top(found, k):
    """The ``k`` best rows of each query of ``(query, c, least, score)`` arrays; a class counts once."""
    query, c, least, score = found
    order = np.lexsort((c, query))
    order = order[np.r_[True, (query[order][1:] != query[order][:-1]) | (c[order][1:] != c[order][:-1])][:len(order)]]
    order = order[np.lexsort((least[order], -score[order], query[order]))]
    own = query[order]
    order = order[np.arange(len(own)) - np.searchsorted(own, own) < k]
    return [x[order] for x in found]


def _compare(k, dim):
    """Task function: the best of each stripe for each query sent to its blocks."""
    def compare(batches):
        import pyarrow as pa

        names = ["query", "c", "least", "score"]
        block = stripe = None
        rows, kept = [], None

        def settle():
            nonlocal kept
            held = pa.Table.from_batches(rows).combine_chunks()
            vectors, asks = _matrix(held.column("vector").combine_chunks(), dim), held.column("is_query").to_numpy()
            c, least = held.column("c").to_numpy(), held.column("least").to_numpy()
            if asks.any() and not asks.all():
                # A block on the seam of two orders may hold a class more than once.
                once = np.flatnonzero(~asks)[np.unique(c[~asks], return_index=True)[1]]
                found = best(vectors[asks], c[asks], vectors[once], c[once], least[once], k)
                kept = _top(found if kept is None else [np.concatenate(x) for x in zip(kept, found)], k)

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            edges = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
            for a, b in zip(edges, [*edges[1:], len(blocks)]):
                if block is not None and blocks[a] != block:
                    settle()
                    rows = []
                if kept is not None and blocks[a] // STRIPE != stripe:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept], names=names)
                    kept = None
                block, stripe = blocks[a], blocks[a] // STRIPE
                rows.append(batch.slice(a, b - a))
        if rows:
            settle()
        if kept is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept], names=names)
    return compare


def near(placed: DataFrame, asking: DataFrame, window: int, k: int, dim: int, total: int) -> DataFrame:
    """The best classes of each asking row among those within ``window`` places of it, of ``total``."""
    least = placed.schema["least"].dataType.simpleString()
    rows = placed.select((F.floor(F.col("place") / BLOCK)).alias("block"), F.lit(False).alias("is_query"), "c", "least", "vector")
    span = F.sequence(F.floor(F.greatest(F.col("place") - window, F.lit(0)) / BLOCK), F.floor((F.col("place") + window) / BLOCK))
    asked = asking.select(F.explode(span).alias("block"), F.lit(True).alias("is_query"), "c", "least", "vector")
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (rows.unionByName(asked).withColumn("stripe", F.floor(F.col("block") / STRIPE))
           .repartition(max(1, min(4 * n, -(-total // (BLOCK * STRIPE)))), "stripe").sortWithinPartitions("stripe", "block").drop("stripe"))
    found = met.mapInArrow(_compare(k, dim), FOUND.format(least=least))
    found = found.groupBy("query", "c").agg(F.max("score").alias("score"), F.first("least").alias("least"))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    return found.withColumn("no", F.row_number().over(w)).where(F.col("no") <= k).drop("no")


def true_neighbours(classes: DataFrame, sample, k: int, dim: int):
    """Best classes of a bounded sample of queries against all: a set for each."""
    numbers, vectors = sample

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                found = best(vectors, numbers, _matrix(batch.column("vector"), dim), batch.column("c").to_numpy(), batch.column("least").to_numpy(), k)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query", "c", "least", "score"])

    least = classes.schema["least"].dataType.simpleString()
    found = classes.select("c", "least", "vector").mapInArrow(scan, FOUND.format(least=least))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    rows = found.withColumn("no", F.row_number().over(w)).where(F.col("no") <= k).select("query", "c").collect()
    return {(r["query"], r["c"]) for r in rows}


def nearest(df: DataFrame, asks: Column, id="vec_id", vector="embedding", k=20, recall=RECALL, window=WINDOW) -> DataFrame:
    """For each row where ``asks`` holds its ``k`` nearest others: ``query_id, rank, vec_id, score``.

    Nearest is the largest inner product in double precision, ties to the smaller
    id; a query with fewer than ``k`` others gets all. Vectors that are null, zero,
    hold null or non-finite components, or are not as long as the longest take no
    part, nor do null ids; rows that repeat id and vector are one. Equal vectors
    stand in the orders once, with their ``k + 1`` smallest ids, which is all a
    list can hold of them. ``id`` is an integer column; other columns play no part;
    an empty table gives no rows.

    The window doubles until ``SAMPLE`` queries find the share ``recall`` of their
    true neighbours, or until it holds the whole table, which is an exact search. In
    vectors without structure it grows with the table.
    """
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (df.select(F.col(id).alias("id"), numbers.alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks"))
            .where("id IS NOT NULL AND vector IS NOT NULL").where(finite).withColumn("length", length).where("length > 0"))
    dim, longest = rows.agg(F.max(F.size("vector")), F.max("length")).first()
    kind = df.schema[id].dataType.simpleString()
    if dim is None:
        return df.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    # -0.0 and 0.0 are one number.
    rows = rows.where(F.size("vector") == dim).select("id", "asks", F.transform("vector", lambda x: x + 0.0).alias("vector"))
    key = F.xxhash64("vector")
    w = Window.partitionBy("hash", "vector").orderBy("id")
    few = (rows.withColumn("hash", key).groupBy("hash", "vector", "id").agg(F.max("asks").alias("asks"))
           .withColumn("no", F.row_number().over(w)).where(F.col("no") <= k + 1))
    classes = few.groupBy("hash", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asking = rows.where("asks").select(F.col("id").alias("query_id"), key.alias("q_hash"), F.col("vector").alias("q_vector")).distinct()
    asked = asking.groupBy("q_hash", "q_vector").agg(F.lit(True).alias("asks"))
    classes = classes.join(asked.hint("merge"), (F.col("hash") == F.col("q_hash")) & (F.col("vector") == F.col("q_vector")), "left")
    classes = materialise(classes.select("hash", "vector", "ids", F.get("ids", F.lit(0)).alias("least"), F.coalesce("asks", F.lit(False)).alias("asks"),
                                         F.monotonically_increasing_id().alias("c")), "vectors")
    curves = _fit(classes, Curves(dim, longest))
    placed = materialise(ordered(classes, curves), "places")
    sample = classes.where("asks").orderBy(F.xxhash64("c")).limit(SAMPLE).select("c", "vector").collect()
    if not sample:
        return df.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    drawn = np.array([r["c"] for r in sample]), np.array([r["vector"] for r in sample])
    truth = true_neighbours(classes, drawn, k + 1, dim)
    total = CURVES * classes.count()
    drawn_rows = materialise(placed.where("asks").join(F.broadcast(classes.where("asks").orderBy(F.xxhash64("c")).limit(SAMPLE).select("c")), "c", "left_semi"), "sample")
    while window < total:
        got = {(r["query"], r["c"]) for r in near(placed, drawn_rows, window, k + 1, dim, total).select("query", "c").collect()}
        if len(got & truth) >= recall * len(truth):
            break
        window *= 2
    found = near(placed, placed.where("asks"), window, k + 1, dim, total)
    lists = found.join(classes.select("c", "ids").hint("merge"), "c").select("query", "score", F.explode("ids").alias("id"))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    lists = (lists.withColumn("no", F.row_number().over(w)).where(F.col("no") <= k + 1).groupBy("query")
             .agg(F.sort_array(F.collect_list(F.struct("no", "id", "score"))).alias("list")))
    own = classes.where("asks").select(F.col("c").alias("query"), F.col("hash").alias("c_hash"), F.col("vector").alias("c_vector"))
    answers = own.join(lists.hint("merge"), "query")
    answers = asking.join(answers.hint("merge"), (F.col("q_hash") == F.col("c_hash")) & (F.col("q_vector") == F.col("c_vector")))
    others = F.slice(F.filter("list", lambda x: x["id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.id").alias("vec_id"), F.col("one.score").alias("score"))
