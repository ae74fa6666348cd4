from collections import Counter

from brute import exact
from fixtures import awkward, documents
from pyspark.sql import functions as F

from opinara.llm.exact_dedup import bitmaps_for, exact_dedup, lower_ascii

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def found(df):
    return Counter(tuple(r) for r in exact_dedup(df).select(COLUMNS).collect())


def test_agrees_with_the_plain_version(spark):
    rows = [*awkward(), (5000, "Hot"), *((i, "hOT") for i in range(2000, 2600)), (None, None), (None, "only null"), (7001, "é É"), (7002, "é É")]
    rows += [(7001, "é É")]
    assert found(documents(spark, rows)) == Counter(exact(rows))


def test_only_ascii_capitals_become_small(spark):
    texts = ["ÀB", "İX", "ⅣA", "ǅZ", "ΣA", "plain ABC", "ß Straße ABC"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lower_ascii(F.col("t")).alias("low"))
    assert all(r["low"] == "".join(c.lower() if c.isascii() else c for c in r["t"]) for r in df.collect())


def test_empty_table_and_clashing_columns(spark):
    empty = documents(spark, [])
    assert exact_dedup(empty).count() == 0
    df = documents(spark, [(1, "a"), (2, "A")]).withColumn("Kept", F.lit(9)).withColumn("cells", F.lit(8))
    rows = exact_dedup(df).collect()
    assert {(r["doc_id"], r["kept"], r["Kept_in"], r["cells"]) for r in rows} == {(1, False, 9, 8), (2, True, 9, 8)}


def test_the_filter_is_bounded_and_the_plan_native(spark):
    assert bitmaps_for(0) == 1 and bitmaps_for(10**12) == 16384
    plan = exact_dedup(documents(spark, awkward()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
