import random
from collections import Counter

import numpy as np
import pyarrow as pa
from brute import divergence
from pyspark.sql import functions as F

from opinara.llm import divergence as module
from opinara.llm.divergence import joint_prices, source_divergence

SCHEMA = "text string, lang string, source string"


def found(df, **options):
    return {tuple(r) for r in source_divergence(df, **options).collect()}


def rows(seed=1, n=700, sources=6):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        source = rnd.choice([None, "", "hot", "hot", "hot", *(f"s{k}" for k in range(sources)), "ß", "Z", "a"])
        words = [rnd.choice("the The THE of a b c d é É ǆ x1y 9 🙂 tie_one tie-two".split()) if rnd.random() < 0.6 else f"w{'abcdefghij'[min(9, int(rnd.expovariate(0.5)))]}" for _ in range(rnd.randrange(0, 40))]
        out.append((rnd.choice([" ".join(words), "", None]) if i % 9 == 0 else " ".join(words), rnd.choice(["en", "en", "en", "de", None]), source))
    return [*out, ("word " * 50_000, "en", "long"), *[("same text", "en", "hot")] * 40, ("rare only", "xx", "one"), (None, "xx", "two"), (None, None, None)]


def test_agrees_with_the_plain_version(spark):
    given = rows()
    assert found(spark.createDataFrame(given, SCHEMA).repartition(5)) == divergence(given)


def test_blocks_tiles_and_pieces_change_nothing(spark, monkeypatch):
    given = rows(2, 400)
    monkeypatch.setattr(module, "BLOCK", 7)
    monkeypatch.setattr(module, "TILE", 2)
    assert found(spark.createDataFrame(given, SCHEMA).repartition(3)) == divergence(given)


def test_counts_sent_on_in_pieces_add_up(monkeypatch):
    given = rows(3, 200)
    columns = [[None if t is None else t.encode() for t, _, _ in given], [x or "" for _, x, _ in given], [x or "" for _, _, x in given]]
    batch = pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), *map(pa.array, columns[1:])], names=["text", "lang", "source"])

    def summed(held):
        monkeypatch.setattr(module, "HELD", held)
        parts, total = list(module._count(iter([batch]))), Counter()
        for row in (r for part in parts for r in part.to_pylist()):
            total.update({(row["lang"], row["source"], row["term"], what): row[what] for what in ("n", "docs")})
        return len(parts), total

    (few, whole), (many, parts) = summed(10**6), summed(20)
    assert whole == parts and many > few


def test_joint_tables_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    left, right = rng.integers(1, 30, (300, 5)), rng.integers(1, 10**9, (300, 3))
    plain = np.abs(left[:, :, None] - right[:, None, :]).sum(axis=0)
    for columns in (1, 40, 10_000):
        monkeypatch.setattr(module, "COLUMNS", columns)
        assert (joint_prices(left, right) == plain).all()
        assert (joint_prices(left, left) == np.abs(left[:, :, None] - left[:, None, :]).sum(axis=0)).all()


def test_counts_beyond_64_bits_of_price(spark):
    df = spark.createDataFrame([(10**15, 3 * 10**15, 2)], "n bigint, total bigint, v bigint")
    assert df.select(module._share("n", "total", "v")).first()[0] == 1 + 10**9 * (10**15 + 5) // (3 * 10**15 + 10)


def test_empty_table_few_rows_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == set()
    few = [("a b", "en", "x"), ("c", "en", "y"), ("c", "fr", "y")]
    df = spark.createDataFrame(few, SCHEMA).withColumns({c: F.lit(1) for c in ("term", "n", "docs", "value", "rank", "item", "doc_id", "LANG_", "block")})
    assert found(df) == divergence(few) == {("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}
