import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from brute import lines
from fixtures import awkward, documents, morse, sentence
from pyspark.sql import functions as F

from opinara.llm import lines as L
from opinara.llm import words as W
from opinara.llm.lines import dedup_lines


def check(spark, rows):
    out = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in dedup_lines(documents(spark, rows)).collect()}
    assert out == lines(rows)


def test_agrees_with_all_pairs(spark):
    check(spark, awkward())


def test_different_words_with_equal_polynomials_stay_apart(spark):
    for n in (512, 2048):
        a, b = morse(n)
        check(spark, [(1, a), (2, b), (3, f"{a} x"), (4, f"{b} x\n{a.upper()}")])


@pytest.mark.parametrize("first", [1, 4])
def test_families_of_lines_with_few_candidates_at_first(spark, monkeypatch, first):
    monkeypatch.setattr(L, "FIRST", first)
    rnd, rows = random.Random(6), []
    base = [sentence(rnd, 20, 5000).split(" ") for _ in range(3)]
    for i in range(150):
        words = list(base[i % 3])
        for j in rnd.sample(range(20), rnd.randrange(0, 4)):
            words[j] = f"n{rnd.randrange(30)}"
        rows.append((i, " ".join(words) + "\n\n" + sentence(rnd, rnd.randrange(1, 7), 9)))
    check(spark, rows)


def test_awkward_rows(spark):
    rows = [(3, "a b c\r\na b c"), (1, None), (2, ""), (None, "a b c"), (7, "q r s t\nx"), (7, "q r s t\nx")]
    df = documents(spark, rows).withColumn("N_LINES", F.lit(5)).withColumn("gone_id", F.lit(6))
    out = dedup_lines(df).collect()
    assert len(out) == 6 and all(r["N_LINES_in"] == 5 and r["gone_id"] == 6 for r in out)
    got = sorted((str(r["doc_id"]), r["n_lines"], r["n_removed"], str(r["text"])) for r in out)
    assert got == [("1", 0, 0, "None"), ("2", 1, 0, ""), ("3", 2, 1, "a b c\r"), ("7", 2, 0, "q r s t\nx"), ("7", 2, 0, "q r s t\nx"), ("None", 1, 1, "")]
    assert dedup_lines(documents(spark, [])).count() == 0


def test_equal_lines_at_one_place_of_different_texts(spark):
    rows = [(None, "a b c\nsome x"), (None, "a b c\nother y"), (7, "q r s\nmore u"), (7, "q r s\nless v"), (8, "k l m"), (8, "k l m")]
    out = dedup_lines(documents(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in out) == [("7", 0), ("7", 1), ("8", 0), ("8", 0), ("None", 0), ("None", 1)]


def test_a_token_row_carries_the_sketch_parts_of_its_set_only():
    n = np.array([3, 60, 200, 400, 48], dtype=np.uint32)
    wide, rnd = L.width_of(n), np.random.default_rng(5)
    rows = {name: rnd.integers(0, 1 << 31, len(n)).astype(kind) for name, kind in L.TOKEN.items()}
    rows["n"], rows["id"] = n, np.array([-1, 0, 7, L.LAST_ID, 1 << 40])
    rows["sketch"] = np.where(np.arange(L.WIDEST) < wide[:, None], rnd.integers(1, 1 << 62, (len(n), L.WIDEST)), 0).astype(np.uint64)
    blobs = [L._pack_tokens(rows, wide, a, b) for a, b in ((0, 2), (2, 2), (2, 5))]
    assert sum(map(len, blobs)) == 3 * 4 + len(n) * 32 + 8 * wide.sum()
    back = L._unpack_tokens(blobs)
    assert set(back) == set(rows) and all(np.array_equal(back[name], rows[name]) for name in rows)


def test_later_passes_take_the_words_of_the_lines_asked_for_only(monkeypatch):
    """The sets of lines that met hash these lines; looking up tokens again makes the sets of lines that hold one."""
    texts = pa.array(["a b\n\nc d e", None, "", "f\n \nc d e\n", "a b"])
    docs = pa.RecordBatch.from_pydict({"id": pa.array([4, 5, 6, 7, 8], pa.int64()), "text_hash": pa.array([1, 2, 3, 4, 5], pa.int64()), "text": texts})
    given = SimpleNamespace(mapInArrow=lambda work, schema: SimpleNamespace(dropDuplicates=lambda keys: list(work([docs]))))
    asked, hashed = np.zeros(L.FILTER_BITS // 8, dtype=np.uint8), []

    def ask(keys):
        cell = keys & np.uint64(L.FILTER_BITS - 1)
        np.bitwise_or.at(asked, (cell >> np.uint64(3)).astype(np.int64), np.uint8(1) << (cell & np.uint64(7)).astype(np.uint8))

    places = [(4, 1, 2), (7, 4, 2), (7, 4, 1)]  # the last has no word
    ask(L.place_key(*(np.array(part) for part in zip(*places))))
    plain = L.word_hashes
    monkeypatch.setattr(L, "word_hashes", lambda offsets, data: hashed.append(data.tobytes()) or plain(offsets, data))
    out = [row for batch in L._sets(given, SimpleNamespace(value=asked)) for row in batch.to_pylist()]
    assert hashed == [b"c d e \nc d e\n"]
    words = np.sort(plain(np.array([0, 5]), np.frombuffer(b"c d e", dtype=np.uint8))[0]).tobytes()
    assert [(row["text_hash"], row["words"]) for row in out] == [(1, words), (4, words)]

    asked[:] = 0
    ask(L.mix(plain(np.array([0, 1]), np.frombuffer(b"b", dtype=np.uint8))[0] >> np.uint64(24)))
    data, offsets = np.frombuffer(b"a b\n\nc d e" + b"f\n \nc d e\n" + b"a b", dtype=np.uint8), np.array([0, 10, 10, 10, 20, 23])
    counts = np.zeros(L.CELLS, dtype=np.uint64)
    every, some = L.Lines(offsets, data, counts), L.Lines(offsets, data, counts, asked)
    assert list(zip(every.text, every.number, every.n)) == [(0, 0, 2), (0, 2, 3), (3, 0, 1), (3, 2, 3), (4, 0, 2)]
    assert list(zip(some.text, some.number, some.n)) == [(0, 0, 2), (4, 0, 2)]
    assert np.array_equal(some.tokens, np.r_[every.tokens[:2], every.tokens[-2:]]) and np.array_equal(some.check, every.check[[0, 4]])


@pytest.mark.parametrize("run", [1, 5, 1 << 15])
def test_hashes_do_not_depend_on_the_run(monkeypatch, run):
    rnd = random.Random(8)
    monkeypatch.setattr(W, "RUN", run)
    texts = ["".join(rnd.choice("aB \t\n\x08\x0e\x1f\x7f") for _ in range(rnd.randrange(40))) for _ in range(200)] + ["x" * 100, ""]
    offsets, data = np.cumsum([0, *map(len, texts)]), np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    hashes, starts, ends = W.word_hashes(offsets, data)
    plain = [re.findall(r"[^\x20\x09-\x0D]+", text.lower()) for text in texts]
    assert [data[a:b].tobytes().decode().lower() for a, b in zip(starts, ends)] == [word for words in plain for word in words]
    assert np.array_equal(np.searchsorted(starts, offsets[:-1]), np.cumsum([0, *map(len, plain[:-1])]))
    polynomials = [sum(int(W.VALUE[b]) * pow(W.BASE, i, 1 << 64) for i, b in enumerate(word.encode())) & W.MASK for words in plain for word in words]
    short = ends - starts <= W.LONG
    assert np.array_equal(hashes[short], W.mix(np.array(polynomials, dtype=np.uint64))[short])


@pytest.mark.parametrize("tries, pairs", [(1, 1), (16, 50)])
def test_candidates_meet_by_size_and_place_only(monkeypatch, tries, pairs):
    rnd, percent, tried, plain = np.random.default_rng(9), 80, [], L.first_matches
    total = 400
    n = rnd.integers(5, 70, total)
    sketch = np.where(np.arange(L.WIDEST) < L.width_of(n)[:, None], rnd.integers(0, 8, (total, L.WIDEST)), 0).astype(np.uint64)
    rows = {"token": rnd.integers(0, 4, total), "place": rnd.integers(0, 6, total) % L.prefix(n, percent), "n": n, "number": np.zeros(total),
            "check": np.arange(total), "id": rnd.permutation(total), "tag": np.zeros(total)}
    rows = {name: values.astype(L.TOKEN[name]) for name, values in rows.items()} | {"sketch": sketch}
    n, place, wide = rows["n"].astype(np.int64), rows["place"].astype(np.int64), L.width_of(n)
    x, y = (z.ravel() for z in np.meshgrid(np.arange(total), np.arange(total)))
    own = (rows["token"][x] == rows["token"][y]) & (rows["id"][x] < rows["id"][y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
    least = L.needed(n[x], n[y], percent)
    own &= np.minimum(place[x], place[y]) + 1 + np.minimum(n[x] - 1 - place[x], n[y] - 1 - place[y]) >= least
    fit = own & (L.apart(sketch[x], sketch[y], wide[x], wide[y]) <= n[x] + n[y] - 2 * least)
    monkeypatch.setattr(L, "TRIES", tries)
    monkeypatch.setattr(L, "PAIRS", pairs)
    monkeypatch.setattr(L, "first_matches", lambda y, who, begin, size, *more: tried.append(size.sum()) or plain(y, who, begin, size, *more))
    expected = set(zip(x[fit].tolist(), y[fit].tolist()))
    a, b, full = L.candidates(rows, percent, 1 << 40, None)
    assert len(a) == len(expected) > 50 and set(zip(a.tolist(), b.tolist())) == expected and not full.any()
    assert sum(tried) == 2 * own.sum() + total  # either way round, and each with itself
    a, b, full = L.candidates(rows, percent, 2, None)
    counts = np.bincount(y[fit], minlength=total)
    assert set(zip(a.tolist(), b.tolist())) <= expected and np.array_equal(np.bincount(b, minlength=total), np.minimum(counts, 2))
    assert np.array_equal(full, counts[b] >= 2)
