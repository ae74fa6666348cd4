import pytest
from brute import WORD
from fixtures import awkward, documents, sentence
from pyspark.sql import functions as F

import random

import numpy as np

from opinara.llm.mixing import copied, mix, settle, targets


def water(sizes, weights, most=3):
    """Shares by weight with a stop, resharing what is over."""
    total, stopped = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in stopped)
        weight = sum(w for i, w in enumerate(weights) if i not in stopped)
        share = [most * s if i in stopped else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in stopped and share[i] > most * s}
        if not over:
            return share
        stopped |= over


def many(n=6000):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rnd.choice(["a", "b", None, "é", "tiny", "z"] if i % 50 == 0 else ["a", "b", None, "é", "z"])
        rows.append((i, sentence(rnd, int(rnd.paretovariate(1.2)) % 400), source))
    return rows


def test_targets_are_shares_with_a_stop(spark):
    sizes = {"a": 5, "b": 1000, "c": 10, "é": 700, None: 3, "z": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in targets(df).collect()}
    order = ["a", "b", "c", "z", "é", None]
    want = water([sizes[s] for s in order], [1, 2, 3, 1, 2, 3])
    assert [got[s] for s in order] == pytest.approx(want)
    assert targets(df.limit(0)).count() == 0


def test_words_come_near_targets_and_reruns_agree(spark):
    rows = many()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    out = mix(df).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        assert r["size"] == len(WORD.findall(r["text"])) and 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        by.setdefault(r["source"], []).append(r)
    order = sorted((s for s in by if s is not None)) + [None]
    sizes = [sum(r["size"] for r in by[s]) for s in order]
    want = water(sizes, [1 + i % 3 for i in range(len(order))])
    for s, size, target in zip(order, sizes, want):
        taken = sum(r["taken"] for r in by[s])
        assert by[s][0]["source_size"] == size and by[s][0]["target"] == pytest.approx(target)
        assert abs(taken - target) <= max(0.01 * target, 3)
    again = mix(df.repartition(2)).select("doc_id", "taken").collect()
    assert {tuple(r) for r in again} == {(r["doc_id"], r["taken"]) for r in out}
    assert copied(mix(df)).count() == sum(r["copies"] for r in out)


def test_every_row_is_taken_in_proportion(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 5), "ab"[i % 4 == 0]) for i in range(400)], "doc_id bigint, text string, source string")
    total = {}
    for seed in range(12):
        for r in mix(df, seed=seed).select("doc_id", "source", "copies", (F.col("target") / F.col("source_size")).alias("p")).collect():
            n, copies, p = total.get(r["source"], (0, 0, 0))
            total[r["source"]] = (n + 1, copies + r["copies"], p + r["p"])
    for n, copies, p in total.values():
        assert copies / n == pytest.approx(p / n, abs=0.06)


def test_awkward_rows(spark):
    rows = [*awkward(), (None, "null id"), (1, "twice twice"), (1, "twice twice")]
    df = documents(spark, rows).withColumn("Target", F.lit("x"))
    out = mix(df).collect()
    assert len(out) == len(rows) and all(r["Target_in"] == "x" and r["taken"] <= 3 * r["size"] for r in out)
    assert len({r["copies"] for r in out if r["text"] == "twice twice" and r["source"] == out[0]["source"]}) <= 1
    assert mix(documents(spark, [])).count() == 0


def test_a_group_keeps_its_words_and_its_rows_their_chance():
    rnd = random.Random(3)
    size = np.array(sorted((int(rnd.paretovariate(0.8)) for _ in range(300)), reverse=True), float)
    open = np.array([rnd.choice([0.05, 0.3, 0.5, 0.97]) for _ in size])
    mean = np.zeros(len(size))
    for _ in range(400):
        gained, left = settle(size, open, [rnd.random() for _ in size])
        assert (left > 0).sum() <= 1 and set(gained) <= {0, 1}
        assert (gained + left) @ size == pytest.approx(open @ size)
        mean += (gained + left) / 400
    assert abs(mean - open).max() < 0.12 and abs((mean - open).mean()) < 0.01


def test_one_row_that_outweighs_all_others_stays_open():
    gained, left = settle(np.array([1000.0, 2, 1]), [0.5, 0.5, 0.5], [0.1, 0.2, 0.3])
    assert left[0] > 0 and not left[1:].any() and (gained + left) @ [1000, 2, 1] == pytest.approx(501.5)
    assert [len(x) for x in settle(np.array([]), [], [])] == [0, 0]


def test_given_sources_come_near_their_targets(spark):
    mixed = mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source"))
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) < 0.016 * r["target"], r  # some 50 rows a source
