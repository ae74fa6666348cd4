import random

from brute import decontaminated
from fixtures import awkward, documents, sentence
from pyspark.sql import functions as F

from opinara.llm.decontaminate import decontaminate

ITEMS = "item_id bigint, text string"


def found(docs, items):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], {w for s in r["spans"] for w in range(s["start"], s["end"])})
            for r in decontaminate(docs, items).collect()}


def planted(seed=1):
    rnd = random.Random(seed)
    items = [(k, sentence(rnd, rnd.choice([1, 2, 4, 5, 7, 9, 10, 11, 14, 30]), 400)) for k in range(40)]
    items += [(100, items[3][1].upper()), (100, items[9][1]), (101, None), (102, ""), (103, " .,! "), (None, sentence(rnd, 12, 30)), (104, "again " * 30), (105, items[9][1])]
    rows = awkward(seed)
    for k in range(60):
        a = rnd.choice([t for _, t in items if t and len(t.split()) > 3]).split(" ")
        cut = rnd.randrange(len(a))
        part = rnd.choice([a, a[cut:], a[:cut], a[: len(a) // 2] + ["other"] + a[len(a) // 2:]])
        rows.append((2000 + k, f"{sentence(rnd, rnd.randrange(0, 30), 400)}, {'-'.join(part)}! {sentence(rnd, rnd.randrange(0, 30), 400)}"))
    common = f"{sentence(rnd, 5)} {items[9][1]} {items[9][1]}"
    rows += [(3000 + k, common) for k in range(50)] + [(3100 + k, f"{common} {k}") for k in range(50)]
    return [*rows, (4000, "again " * 3000), (4001, "É" + items[9][1]), (4002, items[9][1] + "é")], items


def test_agrees_with_the_plain_version(spark):
    for seed in (1, 2):
        rows, items = planted(seed)
        got, due = found(documents(spark, rows), spark.createDataFrame(items, ITEMS)), decontaminated(rows, items)
        assert got == due
        assert sum(v[1] > 0 for v in due.values()) > 60


def test_every_stretch_of_ten_words_is_found(spark):
    rnd = random.Random(5)
    words = [f"u{k}" for k in range(400)]
    rows = [(k, " ".join(f"n{rnd.random()}" for _ in range(rnd.randrange(4))) + " " + " ".join(words[k:k + 10])) for k in range(390)]
    rows += [(1000 + k, " ".join(words[k:k + 9])) for k in range(390)]
    got = decontaminate(documents(spark, rows), spark.createDataFrame([(1, " ".join(words))], ITEMS))
    assert {r["doc_id"]: r["n_hit"] for r in got.collect()} == {k: 10 if k < 1000 else 0 for k, _ in rows}


def test_repeated_and_null_ids_empty_tables_and_clashing_columns(spark):
    item = "one two three four five six seven eight nine ten"
    docs = documents(spark, [(None, f"x {item} y"), (1, item), (1, item), (2, None)])
    docs = docs.withColumns({c: F.lit(7) for c in ("N_hit", "items", "digest", "window", "item", "m", "filter_part", "looked_at")})
    rows = decontaminate(docs, spark.createDataFrame([(5, item), (None, item)], ITEMS).withColumn("words", F.lit(1))).collect()
    assert sorted((str(r["doc_id"]), r["n_hit"], r["n_items"], r["N_hit_in"], r["digest"], r["looked_at"], r["m"]) for r in rows) == [
        ("1", 10, 1, 7, 7, 7, 7), ("1", 10, 1, 7, 7, 7, 7), ("2", 0, 0, 7, 7, 7, 7), ("None", 10, 1, 7, 7, 7, 7)]
    assert decontaminate(documents(spark, []), spark.createDataFrame([(5, item)], ITEMS)).count() == 0
    clean = decontaminate(documents(spark, [(1, item)]), spark.createDataFrame([], ITEMS)).first()
    assert (clean["n_words"], clean["n_hit"], clean["items"], clean["contaminated"]) == (10, 0, [], False)
    unnamed = decontaminate(documents(spark, [(1, item)]), spark.createDataFrame([(None, item)], ITEMS)).first()
    assert (unnamed["n_hit"], unnamed["n_items"], unnamed["contaminated"]) == (10, 0, True)


def test_the_plan_is_native(spark):
    rows, items = planted()
    plan = decontaminate(documents(spark, rows), spark.createDataFrame(items, ITEMS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
