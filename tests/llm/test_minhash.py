import random

import numpy as np
import pytest
from brute import near, shingle_set
from fixtures import awkward, documents, morse, sentence
from pyspark.sql import functions as F

from opinara.llm.minhash import BUCKETS, _connect, drop_near_duplicates, estimate, near_duplicates, registers, text_sets
from opinara.llm.words import blocks, set_key, shingles, word_hashes


def check(spark, rows, k, percent):
    out = {r["doc_id"]: r for r in near_duplicates(documents(spark, rows), k=k, percent=percent).collect()}
    want = near(rows, k, percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in out.items()} == want
    assert all(r["kept"] == (i == want[i][1]) for i, r in out.items())


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_agrees_with_all_pairs(spark, k, percent):
    check(spark, awkward(), k, percent)


def test_different_words_with_equal_polynomials_stay_apart(spark):
    for n in (512, 2048):
        a, b = morse(n)
        check(spark, [(1, a), (2, b), (3, a.upper()), (4, f"{a} x y z"), (5, f"{b} x y z")], 3, 85)


def test_small_sets_and_chains(spark):
    rnd = random.Random(4)
    rows, text = [], sentence(rnd, 60, 10_000).split(" ")
    for i in range(40):  # each close to the one before, the ends far apart
        text[rnd.randrange(60)] = f"c{i}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(f"t{j}" for j in range(i % 9 + 3))) for i in range(30)]
    check(spark, rows, 3, 85)


def test_a_group_whose_members_are_close_to_its_centre_only(spark):
    rnd = random.Random(9)
    base = sentence(rnd, 100, 10_000).split(" ")
    rows = []
    for i in range(60):
        words = list(base)
        for j in rnd.sample(range(100), 2):
            words[j] = f"v{i}x{j}"
        rows.append((i, " ".join(words)))
    rows.append((500, " ".join(base)))
    check(spark, rows, 3, 85)


def test_estimates_are_near_the_truth():
    rnd = random.Random(2)
    a = [f"w{rnd.random()}" for _ in range(2000)]
    b = a[:1600] + [f"v{rnd.random()}" for _ in range(400)]
    import pyarrow as pa

    (_, offsets, data), = blocks(pa.array([" ".join(a), " ".join(b)]))
    words, starts, _ = word_hashes(offsets, data)
    sets = [shingles(words[:2000], 3), shingles(words[2000:], 3)]
    x, y = (shingle_set(" ".join(t), 3) for t in (a, b))
    got = estimate(*(registers(s)[None] for s in sets), np.array([len(x)]), np.array([len(y)]))[0]
    assert got == pytest.approx(len(x & y) / len(x | y), abs=0.1)
    assert len(starts) == 4000 and [len(s) for s in sets] == [len(x), len(y)]


def test_awkward_rows(spark):
    rows = [*awkward(), (None, "null id alone here"), (1, "twice the same text"), (1, "twice the same text"), (2, "twice the same text")]
    df = documents(spark, rows).withColumn("node", F.lit(1)).withColumn("KEPT", F.lit(2))
    out = near_duplicates(df).collect()
    assert len(out) == len(rows)
    assert [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(None, True)]
    assert [r["kept"] for r in out if r["doc_id"] == 1 and r["n_shingles"] == 1] == [True, True]
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in out)
    assert near_duplicates(documents(spark, [])).count() == 0


def test_small_sets_are_settled_whatever_their_estimate():
    import pyarrow as pa

    texts = pa.array([" ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(39)) + " v"], pa.large_string())
    sets = list(text_sets(texts, 3))
    # Registers that agree nowhere: the worst of estimates.
    stamps = [np.full(BUCKETS, i, dtype="<u2").tobytes() for i in (1, 2)]
    rows = pa.RecordBatch.from_arrays(
        [*(pa.array([0, 0], pa.int64()) for _ in range(4)), pa.array([5, 6], pa.int64()), pa.array([set_key(s) for s in sets]),
         pa.array(stamps), pa.array([len(s) for s in sets], pa.int64()), texts],
        names=["cluster", "low", "high", "tile", "c", "node", "registers", "n", "text"])
    out = pa.Table.from_batches(_connect(3, 85)([rows])).to_pylist()
    assert out == [{"a": 5, "b": 6}]


def test_a_null_id_near_a_document_with_an_id_goes(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(4, " ".join(words)), (None, " ".join([*words[:59], "v"])), (None, "nothing like the others here")]
    out = near_duplicates(documents(spark, rows), k=3, percent=85).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in out) == [("4", "4", True), ("None", "4", False), ("None", "None", True)]
