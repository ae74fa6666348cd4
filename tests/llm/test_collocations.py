import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from brute import LOWER, collocated
from pyspark.sql import functions as F

from opinara.llm import collocations as module
from opinara.llm.collocations import collocations, dictionary

SCHEMA = "text string, lang string"


def found(df):
    return {tuple(r) for r in collocations(df).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def rows(seed=1, n=500):
    rnd = random.Random(seed)
    passage = " ".join(f"p{rnd.randrange(60)}" for _ in range(80))
    out = [(None, "en"), ("", "en"), (" \t . ,,", None), ("one", "en"), ("New York City! " * 15, "en"), ("NEW\tYork, new york: New York" * 9, "en"), ("a a a a a", "en")]
    for k in range(n):
        words = [rnd.choice(["the", "of", "É", "é", "x\x00y", "\x1cz", "🙂", "new york city", "tie one", "tie two", *(f"w{j}" for j in range(25))]) + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", "\x0b", "\r\n", "?"])
                 for _ in range(rnd.randrange(60))]
        out.append(("".join(words) + (passage.upper() if k % 3 == 0 else ""), rnd.choice(["en", "en", "de", None, "und"])))
    return [*out, ("again " * 30_000, "en"), (passage * 40, "fr"), *[(passage, "en")] * 200]


def test_agrees_with_the_plain_version(spark):
    for seed in (1, 2):
        given = rows(seed)
        due = collocated(given)
        assert found(spark.createDataFrame(given, SCHEMA).repartition(5)) == due
        assert {len(r[2].split(" ")) for r in due} == {2, 3}


def test_each_occurrence_counts_once_however_chunks_fall(monkeypatch):
    given = rows(3, 120)
    batch = pa.RecordBatch.from_arrays([pa.array([None if t is None else t.encode() for t, _ in given], pa.binary()), pa.array([x or "und" for _, x in given])], names=["text", "lang"])
    due = Counter()
    for text, lang in given:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            due.update((lang or "und", " ".join(ws[i:i + k])) for k in (1, 2, 3) for i in range(len(ws) - k + 1))
    monkeypatch.setattr(module, "PARSED", 3000)
    monkeypatch.setattr(module, "CHUNKS_HELD", 4000)
    monkeypatch.setattr(module, "COUNTED", 5000)
    full = _Full()
    for every, most in ((1, 5), (2, 17), (16, 4096), (10**6, 100)):
        monkeypatch.setattr(module, "EVERY", every)
        monkeypatch.setattr(module, "LONGEST_CHUNK", most)
        chunks = list(module._parse(iter([batch])))
        assert len(chunks) > 1
        got = Counter()
        for size in (1, 2, 3):
            for part in module._counter(size, [full, full])(iter(chunks)):
                for row in part.to_pylist():
                    got[row["lang"], row["phrase"]] += row["n"]
        assert got == due


class _Full:
    """A filter that lets everything through."""

    value = np.full(module.CELLS // 8, 255, dtype=np.uint8)


def test_equal_passages_share_chunks(spark):
    rnd = random.Random(4)
    passage = " ".join(f"p{rnd.randrange(900)}" for _ in range(400))
    given = [(f"{' '.join(f'n{rnd.random()}' for _ in range(7))} {passage}", "en") for _ in range(60)]
    assert max(r["n"] for r in dictionary(spark.createDataFrame(given, SCHEMA)).collect()) == 60


def test_large_counts_are_exact(spark):
    big = 3 * 10**14
    counts = spark.createDataFrame([("en", "a", big, 1), ("en", "b", big + 7, 1), ("en", "a b", big - 1, 2)], "lang string, phrase string, n bigint, size int")
    row = module._scored(counts).first()
    assert row["score"] == 10**6 * (big - 1) ** 2 // (big * (big + 7))


def test_empty_table_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == set()
    given = [("a b c", "en")] * 12
    df = spark.createDataFrame(given, SCHEMA).withColumns({c: F.lit(1) for c in ("chunk", "n", "phrase", "rank", "doc_id", "size")})
    assert found(df) == collocated(given)
