import hashlib
import random

import numpy as np
import pytest
from brute import smoothed
from fixtures import awkward, documents, sentence
from pyspark.sql import functions as F

from opinara.llm.queries import registry
from opinara.llm.toxicity import Model, count_model, drop_toxic, fold, measures, score, train

INSULTS = ["gruff", "blargh", "snork"]


def corpus(n=1200, seed=2):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words, toxic = sentence(rnd, rnd.randrange(5, 120)).split(" "), i % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    return docs, frame, train(docs, frame)


def test_held_out_rows_are_told_apart(spark, trained):
    docs, _, model = trained
    out = score(docs, model).where(fold(F.col("doc_id")) == 2).toPandas()
    toxic = out["doc_id"] % 5 == 0
    assert out["score"].between(0, 1).all() and ((out["predicted"] == 1) == (out["score"] >= 0.3)).all()
    assert out["predicted"][toxic].mean() > 0.95 and out["predicted"][~toxic].mean() < 0.05


def test_held_out_labels_are_never_learned(spark, trained):
    docs, labels, model = trained
    other = labels.withColumn("toxic", F.when(fold(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = train(docs, other)
    assert np.array_equal(again.fit, model.fit) and again.unseen == model.unseen
    rows = [sorted(map(tuple, m.entries.select('kind', 'part', 'blob').collect())) for m in (model, again)]
    assert rows[0] == rows[1]


def test_scores_do_not_depend_on_partitions(spark, trained):
    docs, labels, model = trained
    again = train(docs.repartition(7), labels.repartition(2))
    want = {r["doc_id"]: r["score"] for r in score(docs, model).collect()}
    assert want == {r["doc_id"]: r["score"] for r in score(docs.repartition(5), again).collect()}


@pytest.mark.parametrize("frequent, chunk", [(1 << 16, 1 << 20), (8, 1 << 20), (8, 1)])
@pytest.mark.parametrize("classes", [(0, 1), (0,), (1,)])
def test_plain_models_say_the_same(spark, classes, frequent, chunk):
    rows, labels = corpus(300, seed=8)
    texts, known = dict(rows), [(i, toxic) for i, toxic in labels if toxic in classes]
    training = [(texts[i], toxic) for i, toxic in known] + [(None, classes[0]), ("", classes[0]), ("Alone", classes[0]), ("gruff", classes[-1])]
    model = count_model(spark.createDataFrame(training, "text string, toxic int").repartition(5), frequent)
    judge = smoothed(training)
    asked = [*texts.values(), None, "", " ", "alone", "never seen before", "GRUFF gruff never gruff", "gruff " * 200_000, "gruff " * 200_000]
    frame = spark.createDataFrame([(text,) for text in asked], "text string").repartition(3)
    found = {bytes(r["key"]): r for r in measures(frame, model, chunk=chunk).collect()}
    assert len(found) == len({text or "" for text in asked})
    for text in asked:
        row = found[hashlib.md5((text or "").encode()).digest()]
        assert np.allclose([row["mean"], row["top"]], judge(text), atol=1e-4), text
        assert row["words"] == float(bool((text or "").strip()))


def test_awkward_rows(spark, trained):
    _, labels, model = trained
    rows = [*awkward(), (None, "gruff blargh"), (1, "gruff snork gruff"), (1, "gruff snork gruff")]
    df = documents(spark, rows).withColumn("Score", F.lit("s"))
    out = score(df, model).collect()
    assert len(out) == len(rows) and all(r["Score_in"] == "s" and 0 <= r["score"] <= 1 for r in out)
    kept = drop_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r["predicted"] == 0 for r in out)
    assert score(documents(spark, []), model).count() == 0
    nothing = train(documents(spark, []), labels)
    assert isinstance(nothing, Model) and 0 < score(df, nothing).first()["score"] < 1
    one = train(documents(spark, corpus()[0]), labels.withColumn("toxic", F.lit(None).cast("int")))
    assert 0 < score(df, one).first()["score"] < 1


def test_held_out_accuracy_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    out = registry()["op8_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").toPandas()
    hit = out[out["toxic"] == 1]["predicted"].mean()
    wrong = out[out["toxic"] == 0]["predicted"].mean()
    assert hit > 0.8 and wrong < 0.05
