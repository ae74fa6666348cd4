import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import neighbours as N
from opinara.llm.neighbours import hilbert, nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def run(df, **options):
    out = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0, **options).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(rows) for q, rows in out.items()}


def truth(ids, x, q, k):
    own = x[list(ids).index(q)]
    products = x @ own
    order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-products[i], ids[i]))[:k]
    return [ids[i] for i in order]


@pytest.mark.parametrize("bits, dims", [(3, 2), (2, 3), (2, 4)])
def test_hilbert_steps_are_single(bits, dims):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = hilbert(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_recall_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 64)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 24)) * 3
    x = (centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 24))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA).repartition(4)
    out, x, hits = run(df, window=64), x.astype(np.float64), 0
    assert sorted(out) == list(range(0, 3000, 20))
    for q, rows in out.items():
        assert [r[0] for r in rows] == list(range(1, 21)) and q not in [r[1] for r in rows]
        assert [r[2] for r in rows] == pytest.approx([x[q] @ x[r[1]] for r in rows], abs=1e-9)
        hits += len({r[1] for r in rows} & set(truth(range(3000), x, q, 20)))
    assert hits / (20 * len(out)) >= 0.9


def test_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5)).astype(np.float32)
    x[:45] = x[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [(100, None, 0), (120, [0.0] * 5, 0), (140, [1.0, None, 1.0, 1.0, 1.0], 0), (160, [float("nan")] * 5, 0), (180, [float("inf")] + [1.0] * 4, 0),
           (200, [1.0, 2.0], 0), (None, [1.0] * 5, 0), (220, [], 0)]
    df = spark.createDataFrame(rows + bad + rows[:3], SCHEMA).withColumn("rank", F.lit(1)).withColumn("score", F.lit("x"))
    out = run(df)
    assert sorted(out) == [0, 20, 40]
    for q, got in out.items():
        assert [r[1] for r in got] == truth(range(60), x.astype(np.float64), q, 20)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [-1.0, 0.0], 0)], SCHEMA)
    assert [r[1] for r in run(df)[0]] == [1, 2]
    assert run(df.where("vec_id > 0")) == {} and run(df.limit(0)) == {} and run(df.where("vec_id = 0")) == {}


@pytest.mark.parametrize("n", [1, 2, 21, 60, 700, 900, 2049])
def test_small_tables_give_all_they_must(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 16)).astype(np.float32)
    out, x, hits = run(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)), x.astype(np.float64), 0
    assert sorted(out) == [q for q in range(0, n, 20) if n > 1]
    for q, rows in out.items():
        due = truth(range(n), x, q, 20)
        assert [r[0] for r in rows] == list(range(1, len(due) + 1))
        assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        hits += len({r[1] for r in rows} & set(due)) / len(due)
    assert not out or hits / len(out) >= (1 if n <= 512 else 0.9)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_the_registered_query_has_the_recall_it_needs(spark, sf):
    from opinara.llm.queries import op10_neighbours

    given = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r["vec_id"] for r in given], np.array([r["embedding"] for r in given], dtype=np.float64)
    out = {}
    for r in op10_neighbours(spark, f"/root/testdata/{sf}").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(out) == [i for i in ids if i % 20 == 0]
    assert all(sorted(r[0] for r in rows) == list(range(1, 21)) for rows in out.values())
    hits = sum(len({r[1] for r in rows} & set(truth(ids, x, q, 20))) for q, rows in out.items())
    assert hits / (20 * len(out)) >= 0.9
