import hashlib

import numpy as np
import pytest
from fixtures import awkward, documents
from pyspark.sql import functions as F

from opinara.llm.training_order import Permutation, read_slots, shard_folder, write_training_order


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation_is_one_to_one_and_keyed(n):
    order = Permutation(n, 11)
    slots = order.slots(np.arange(n))
    assert sorted(slots) == list(range(n)) and (order.sequences(slots) == np.arange(n)).all()
    if n > 100:
        assert (Permutation(n, 12).slots(np.arange(n)) != slots).mean() > 0.9


@pytest.mark.parametrize("stored", [True, False])
def test_shards_hold_the_stream_in_the_order_of_the_slots(spark, tmp_path, stored):
    rows = [*awkward(), (None, "null id"), (1, "twice"), (1, "twice")]
    path = str(tmp_path / "docs")
    documents(spark, rows).withColumn("slot", F.lit(1)).write.parquet(path)
    df = spark.read.parquet(path).select(F.col("text").cast("binary").alias("tokens"), "slot")
    folder = shard_folder(spark)
    out = write_training_order(df, folder, key=5, length=100, shard_bytes=1000, stored=stored).toPandas()
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    n = -(-total // 100)
    assert sorted(out["slot"]) == list(range(n)) == sorted(out["sequence"]) and out["n_tokens"].sum() == total
    data = list(read_slots(folder, 0, n, length=100, shard_bytes=1000))
    assert len(data) == n and data[7:30] == list(read_slots(folder, 7, 23, length=100, shard_bytes=1000))
    by_sequence = dict(zip(out["sequence"], out["slot"]))
    stream = b"".join(data[by_sequence[i]] for i in range(n))
    assert sorted(stream[:total].split(b"\xff")[:-1]) == sorted((t or "").encode() for _, t in rows)
    assert set(stream[total:]) <= {255}
    for r in out.itertuples():
        assert r.sequence_sha256 == hashlib.sha256(data[r.slot]).hexdigest()
        assert (r.shard, r.byte_offset) == (r.slot // 10, r.slot % 10 * 100)
    again = write_training_order(df, shard_folder(spark), key=5, length=100, shard_bytes=1000, stored=stored).toPandas()
    key = ["sequence"]
    assert stored is False or again.sort_values(key).equals(out.sort_values(key)) or \
        again.sort_values(key).reset_index(drop=True).equals(out.sort_values(key).reset_index(drop=True))


def test_wide_tokens_and_an_empty_table(spark):
    ids = [np.arange(i, dtype="<u2").tobytes() for i in range(20)]
    df = spark.createDataFrame([(bytearray(b),) for b in ids], "tokens binary")
    folder = shard_folder(spark)
    out = write_training_order(df, folder, length=8, width=2, end=b"\xff\xff", shard_bytes=64).toPandas()
    assert out["n_tokens"].sum() == sum(range(20)) + 20
    assert all(len(x) == 16 for x in read_slots(folder, 0, len(out), length=8, width=2, shard_bytes=64))
    assert write_training_order(df.limit(0), shard_folder(spark)).count() == 0
