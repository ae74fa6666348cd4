"""Near duplicates by HyperMinHash registers, banded, estimated and then verified on full sets (op 4).

Each document's shingle hashes fall into buckets by their first bits. A register
keeps of a bucket's least hash the number of leading zeros and ten bits of
mantissa; an empty bucket borrows the register of a bucket that a fixed random
sequence names. Documents with the same set are one class. Classes that agree in
a band of registers meet; the estimate from all registers, corrected for chance
agreement, leaves out pairs that are clearly apart, and the rest are settled on
the full sets.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialise, names_for, possibly_in
from .words import stream, blocks, mix, per_text, set_key, shingles, word_hashes

BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
ROWS = 6
BANDS = BUCKETS // ROWS
MARGIN = 0.15  # some six standard deviations of the estimate near the thresholds in use
SMALL = 256  # sets of fewer shingles borrow registers, which spreads the estimate; they are settled on the sets alone
TILE_ROWS, TILE_SHINGLES = 512, 1 << 20

# Fixed random sequences of buckets to borrow from.
_PROBES = (mix(np.arange(BUCKETS * 512, dtype=np.uint64) + stream(4, 1)[0]) % np.uint64(BUCKETS)).astype(np.int64).reshape(BUCKETS, 512)
_BOUNDS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)


def registers(hashes):
    """HyperMinHash registers of a sorted, non-empty set of hashes."""
    first = np.searchsorted(hashes, _BOUNDS)
    filled = np.r_[first[1:], len(hashes)] > first
    rest = hashes[np.minimum(first, len(hashes) - 1)] << np.uint64(BUCKET_BITS)
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    mantissa = (rest << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    out = (zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | mantissa
    empty, at = np.flatnonzero(~filled), 0
    while len(empty):
        if at >= _PROBES.shape[1]:
            # Only with a handful of hashes: the next filled bucket, as different for each bucket as can be.
            ready = np.flatnonzero(filled)
            out[empty] = out[ready[_PROBES[empty, 0] % len(ready)]]
            break
        asked = _PROBES[empty, at:at + 16]
        good = filled[asked]
        found = good.any(axis=1)
        out[empty[found]] = out[asked[found, good[found].argmax(axis=1)]]
        empty, at = empty[~found], at + 16
    return out.astype("<u2")


def estimate(a, b, n_a, n_b):
    """Jaccard estimates of rows of registers, less the agreements expected by chance."""
    agree = (a == b).sum(axis=1)
    ratio = np.maximum(n_a, n_b) / np.maximum(np.minimum(n_a, n_b), 1)
    # The constant of Yu and Weber's approximation (HyperMinHash, 2017).
    chance = 0.169919487159739093 * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(agree - chance, 0) / BUCKETS


def text_sets(array, k):
    """The shingle sets of an Arrow array of texts, one after the other."""
    for _, offsets, data in blocks(array):
        words, starts, _ = word_hashes(offsets, data)
        edges = per_text(offsets, starts)
        for i in range(len(offsets) - 1):
            yield shingles(words[edges[i]:edges[i + 1]], k)


def signatures(df: DataFrame, k: int) -> DataFrame:
    """``(id, text_hash, text)`` to ``(id, text_hash, n_shingles, node, registers)``; no node without words."""
    def sign(batches):
        import pyarrow as pa

        for batch in batches:
            sizes, nodes, held = [], [], []
            for hashes in text_sets(batch.column("text"), k):
                sizes.append(len(hashes))
                nodes.append(set_key(hashes) if len(hashes) else None)
                held.append(registers(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                 pa.array(nodes, pa.binary()), pa.array(held, pa.binary())],
                names=["id", "text_hash", "n_shingles", "node", "registers"])

    kind = df.schema["id"].dataType.simpleString()
    return df.mapInArrow(sign, f"id {kind}, text_hash bigint, n_shingles bigint, node binary, registers binary")


def clusters(classes: DataFrame) -> DataFrame | None:
    """Classes that agree in any band, directly or through others, ``(c, cluster)``; None if there are none.

    In each bucket all members are tied to the first, so a bucket gives as many
    edges as it has members, whatever its size.
    """
    band = F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("registers"), i * (2 * ROWS) + 1, F.lit(2 * ROWS)))))
    members = classes.select("c", band).select("c", F.col("col").alias("key"))
    first = (members.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
             .where("lo < hi").select("key", "lo"))
    edges = members.join(first.hint("merge"), "key").where("c != lo").select(F.col("c").alias("a"), F.col("lo").alias("b"))
    edges = materialise(edges.distinct(), "bands")
    if edges.isEmpty():
        return None
    return components(edges, "clusters").select(F.col("node").alias("c"), F.col("root").alias("cluster"))


def links(classes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame | None:
    """Root of every linked class, ``(node, root)``; None if nothing is linked.

    A cluster is dealt into tiles of a bounded size, and every two tiles of it meet
    in a group of rows, so that any two members meet once or more. There the
    registers are compared; of what they do not rule out, pairs that are not yet
    connected are settled on the full sets, and only links that connect anything
    are returned: fewer than a group has members.
    """
    found = clusters(classes)
    if found is None:
        return None
    named = materialise(classes.join(found.hint("merge"), "c"), "clustered")
    tiles = F.ceil(F.greatest(F.count(F.lit(1)) / TILE_ROWS, F.sum("n") / TILE_SHINGLES)).cast("int")
    sizes = named.groupBy("cluster").agg(tiles.alias("tiles"))
    named = named.join(sizes.hint("merge"), "cluster").withColumn("tile", F.pmod(F.xxhash64("c"), F.col("tiles")).cast("int"))
    owners = named.select("c", "node", "rep_hash", "registers", "n", "cluster", "tiles", "tile")
    own = possibly_in(texts, F.col("text_hash"), named, "rep_hash").dropDuplicates(["text_hash"])
    own = own.join(owners.hint("merge"), F.col("text_hash") == F.col("rep_hash"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    met = own.select("cluster", "c", "node", "registers", "n", "text", "tile", other).select(
        "cluster", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "c", "node", "registers", "n", "text")
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["cluster", "low", "high"]
    met = met.repartition(4 * n, *keys).sortWithinPartitions(*keys)
    edges = materialise(met.mapInArrow(_connect(k, percent), "a bigint, b bigint").distinct(), "links")
    return None if edges.isEmpty() else components(edges, "components")


def _connect(k, percent):
    """Task function: links that connect the members of each group of rows."""
    least = percent / 100 - MARGIN

    def settle(rows):
        import pyarrow as pa

        held = pa.Table.from_batches(rows).combine_chunks()
        c, tile, n = (held.column(x).to_numpy() for x in ("c", "tile", "n"))
        low, high = held.column("low")[0].as_py(), held.column("high")[0].as_py()
        stamps = np.frombuffer(b"".join(held.column("registers").to_pylist()), dtype="<u2").reshape(-1, BUCKETS)
        nodes = held.column("node").to_pylist()
        texts = held.column("text")
        sets, root = {}, list(range(len(c)))

        def of(i):
            if i not in sets:
                own = next(text_sets(texts.slice(i, 1).combine_chunks(), k))
                # Another text of the same hash is not the class's text.
                sets[i] = own if set_key(own) == nodes[i] else own[:0]
            return sets[i]

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        a, b = [], []
        for i in range(len(c)):
            rest = np.arange(i + 1, len(c)) if low == high else np.flatnonzero(tile[i + 1:] != tile[i]) + i + 1
            rest = rest[100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])]
            if not len(rest):
                continue
            guess = estimate(stamps[rest], stamps[i], n[rest], n[i])
            good = np.flatnonzero((guess >= least) | (np.minimum(n[rest], n[i]) < SMALL))
            for j in rest[good[np.argsort(-guess[good], kind="stable")]].tolist():
                if find(i) == find(j):
                    continue
                both = np.concatenate([of(i), of(j)])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                if shared and 100 * shared >= percent * (len(both) - shared):
                    root[find(j)] = find(i)
                    a.append(c[i])
                    b.append(c[j])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def connect(batches):
        held, rows = None, []
        for batch in batches:
            keys = np.stack([batch.column(x).to_numpy() for x in ("cluster", "low", "high")], axis=1)
            edges = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)][:len(keys)])
            for x, y in zip(edges, [*edges[1:], len(keys)]):
                key = tuple(keys[x])
                if held not in (None, key):
                    yield settle(rows)
                    rows = []
                held = key
                rows.append(batch.slice(x, y - x))
        if rows:
            yield settle(rows)
    return connect


def near_duplicates(df: DataFrame, id="doc_id", text="text", k=5, percent=80) -> DataFrame:
    """One row a document: ``id, n_shingles, component_id, kept, text_hash``.

    Documents are linked when ``100 * intersection >= percent * union`` of their
    sets of ``k``-word shingles (words as in ``words``; fewer than ``k`` words are
    one shingle). ``component_id`` is the smallest id that links reach, and the
    document of that id is kept. Without words (null or empty text) a document
    stands alone and is kept. A null id is kept only where no other id is in the
    component. Rows that repeat id and text are kept or dropped alike. Any other
    columns, whatever their names, play no part; an empty table gives no rows. A
    text's set is held in one task while it is handled.

    Exact copies meet by a digest of their set, in an aggregate that combines
    before the shuffle. At the threshold a link is missed by all bands with a
    probability under 1e-8 (0.85) or 3e-6 (0.8).
    """
    docs = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))
    signed = materialise(signatures(docs, k), "signatures")
    classes = (signed.where("node IS NOT NULL").groupBy("node")
               .agg(F.min("id").alias("rep"), F.min("text_hash").alias("rep_hash"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")))
    classes = materialise(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    texts = docs.select("text_hash", "text")
    roots = links(classes, texts, k, percent)
    named = classes.select("node", "c", "rep")
    if roots is None:
        named = named.withColumn("component_id", F.col("rep"))
    else:
        label = roots.select(F.col("node").alias("c"), "root")
        named = named.join(label.hint("merge"), "c", "left").withColumn("root", F.coalesce("root", "c"))
        least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
        named = named.join(least.hint("merge"), "root")
    out = signed.drop("registers").join(named.select("node", "component_id").hint("merge"), "node", "left")
    alone = F.col("node").isNull()
    return out.select(
        F.col("id").alias(id), "n_shingles",
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"), "text_hash")


def drop_near_duplicates(df: DataFrame, id="doc_id", text="text", k=5, percent=80) -> DataFrame:
    """The rows of ``df`` that ``near_duplicates`` keeps, with their columns as they are."""
    gone = near_duplicates(df, id, text, k, percent).where(~F.col("kept"))
    g_id, g_hash = names_for(df, "gone_id", "gone_hash")
    gone = gone.select(F.col(id).alias(g_id), F.col("text_hash").alias(g_hash)).distinct()
    own = F.xxhash64(F.col(text).cast("string"))
    return df.join(gone, F.col(id).eqNullSafe(F.col(g_id)) & (own == F.col(g_hash)), "left_anti")
