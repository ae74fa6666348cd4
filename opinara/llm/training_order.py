"""Training-order materialisation of token ids as fixed-stride binary shards (op 2).

The token streams of all rows, each closed by an end token, form one stream that
is cut into sequences of equal length. A keyed Feistel permutation, walked along
its cycle until it falls below the number of sequences, gives each sequence its
slot. A shard holds a range of slots, so byte ``slot * stride`` of the whole is
found without an index, and reading can start or resume anywhere.
"""

import hashlib
import uuid
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_folder
from ..sources.archives import filesystem
from .common import materialise
from .words import mix

ROUNDS = 6
LENGTH = 2048
SHARD_BYTES = 16 << 20

WRITTEN = "sequence bigint, slot bigint, shard int, byte_offset bigint, n_tokens int, sequence_sha256 string, path string"


class Permutation:
    """A keyed permutation of ``range(n)``; works on arrays."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        seeds = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.keys = mix(seeds + np.uint64(key & ((1 << 64) - 1)))

    def _round(self, x, key):
        return mix(x + key) & self.mask

    def _once(self, x):
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _back(self, x):
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ self._round(left, key), left
        return (left << self.half) | right

    def _walk(self, x, step):
        x = step(np.asarray(x, dtype=np.uint64))
        while True:
            out = np.flatnonzero(x >= self.n)
            if not len(out):
                return x.astype(np.int64)
            x[out] = step(x[out])

    def slots(self, sequences):
        return self._walk(sequences, self._once)

    def sequences(self, slots):
        return self._walk(slots, self._back)


def _pieces(shared, width, end, length, per_shard, order):
    """Task function: cut the stream of one partition into the parts of sequences."""
    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        base, expected = shared.value.get(number, (0, 0))
        at, held = base, bytearray()
        stride = length * width

        def rows(upto_end):
            nonlocal at, held
            sequences, starts, parts = [], [], []
            place, view = 0, bytes(held)
            while True:
                start = (at % length) * width
                size = min(stride - start, len(view) - place)
                if not size or (size < stride - start and not upto_end):
                    break
                sequences.append(at // length)
                starts.append(start)
                parts.append(view[place:place + size])
                place += size
                at += size // width
            held = bytearray(view[place:])
            if sequences:
                slots = order.slots(np.array(sequences))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((slots // per_shard).astype(np.int32)), pa.array(slots), pa.array(sequences, pa.int64()),
                     pa.array(starts, pa.int32()), pa.array(parts, pa.binary())],
                    names=["shard", "slot", "sequence", "start", "part"])

        seen = 0
        for batch in batches:
            for value in batch.column(0):
                tokens = value.as_buffer() if value.is_valid else None
                if tokens is not None:
                    held += memoryview(tokens)
                    seen += len(tokens)
                held += end
                seen += len(end)
                if len(held) > 8 << 20:
                    yield from rows(False)
        yield from rows(True)
        if seen // width != expected:
            raise RuntimeError(f"partition {number} holds {seen // width} tokens where {expected} were counted")
    return cut


def _shards(folder, width, end, length, per_shard, n, total):
    """Task function: write shards from parts sorted by slot."""
    stride = length * width

    def write(batches):
        import pyarrow as pa

        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        names = ["sequence", "slot", "shard", "byte_offset", "n_tokens", "sequence_sha256", "path"]
        out = held = partial = shard = None
        rows = []

        def finish_sequence():
            nonlocal held
            if held is not None:
                sequence, slot, data, tokens = held
                tokens //= width
                wanted = min(length, total - sequence * length)
                if tokens != wanted:
                    raise RuntimeError(f"sequence {sequence} has {tokens} tokens, not {wanted}")
                data += end * (length - tokens)
                out.write(bytes(data))
                rows.append((sequence, slot, shard, (slot % per_shard) * stride, tokens,
                             hashlib.sha256(data).hexdigest(), f"{shard:08d}.bin"))
                held = None

        def finish_shard():
            finish_sequence()
            if out is not None:
                out.close()
                files.move(partial, f"{root}/{shard:08d}.bin")

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    finish_shard()
                    shard = row["shard"]
                    partial = f"{root}/.{shard:08d}.{uuid.uuid4().hex}"
                    out = files.open_output_stream(partial)
                if held is None or held[1] != row["slot"]:
                    finish_sequence()
                    held = [row["sequence"], row["slot"], bytearray(), 0]
                held[2] += row["part"]
                held[3] += len(row["part"])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
                rows.clear()
        finish_shard()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    def typed(batches):
        schema = pa_schema()
        for batch in write(batches):
            yield batch.cast(schema)

    def pa_schema():
        import pyarrow as pa

        return pa.schema([("sequence", pa.int64()), ("slot", pa.int64()), ("shard", pa.int32()), ("byte_offset", pa.int64()),
                          ("n_tokens", pa.int32()), ("sequence_sha256", pa.string()), ("path", pa.string())])
    return typed


def write_training_order(df: DataFrame, folder: str, tokens="tokens", key=0, length=LENGTH, width=1,
                         end=b"\xff", shard_bytes=SHARD_BYTES, stored=False) -> DataFrame:
    """Write the shards below ``folder``; rows ``(sequence, slot, shard, byte_offset, n_tokens, sequence_sha256, path)``.

    ``tokens`` is a binary column of ids of ``width`` bytes each, ``end`` the id
    that closes a row. A null or empty row gives its end token only; rows of any
    length run on over sequences; repeated rows each have their place; the last
    sequence is filled up with end tokens; other columns play no part. An empty
    table writes nothing. The stream's order is that of the stored table's
    partitions: ``stored`` says that ``df`` is a projection of stored files, which
    a lost task reads again as they were; any other frame is written first. One
    count per partition reaches the driver, and every token shuffles once. Shards
    are written under a task's own name and moved when complete. The files appear
    when the result is used.
    """
    if len(end) != width:
        raise ValueError("the end token must be one token wide")
    df = df.select(F.col(tokens).cast("binary").alias("tokens"))
    if not stored:
        df = materialise(df, "tokens")
    spark = df.sparkSession
    counted = (df.groupBy(F.spark_partition_id().alias("part"))
               .agg(F.sum(F.coalesce(F.octet_length("tokens"), F.lit(0)) / width + 1).cast("bigint").alias("n")).collect())
    counted = sorted((r["part"], r["n"]) for r in counted)
    bases = [0, *accumulate(n for _, n in counted)]
    total = bases[-1]
    n = -(-total // length)
    per_shard = max(1, shard_bytes // (length * width))
    shards = max(1, -(-n // per_shard))
    shared = spark.sparkContext.broadcast({part: (base, size) for (part, size), base in zip(counted, bases)})
    order = Permutation(n, key)
    parts = df.mapInArrow(_pieces(shared, width, end, length, per_shard, order),
                          "shard int, slot bigint, sequence bigint, start int, part binary")
    parts = parts.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot", "start")
    return parts.mapInArrow(_shards(folder, width, end, length, per_shard, n, total), WRITTEN)


def read_slots(folder: str, first: int, count: int, length=LENGTH, width=1, shard_bytes=SHARD_BYTES):
    """Yield the sequences of ``count`` slots from slot ``first`` on, without any index."""
    files, root = filesystem(folder)
    stride = length * width
    per_shard = max(1, shard_bytes // stride)
    slot = first
    while slot < first + count:
        shard = slot // per_shard
        with files.open_input_file(f"{root}/{shard:08d}.bin") as shard_file:
            shard_file.seek((slot % per_shard) * stride)
            for slot in range(slot, min(first + count, (shard + 1) * per_shard)):
                data = shard_file.read(stride)
                if len(data) < stride:
                    return
                yield data
        slot += 1


def shard_folder(spark) -> str:
    return work_folder(spark, "shards")
