import random

import numpy as np
import pytest
from brute import repeats
from fixtures import awkward, documents
from pyspark.sql import functions as F

from opinara.llm import suffixes as S
from opinara.llm.suffixes import LENGTH, Suffixes, hashes_of, remove_repeats


def check(spark, rows):
    out = remove_repeats(documents(spark, rows)).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out)
    assert got == sorted(repeats(rows))


def test_agrees_with_all_strings(spark):
    check(spark, awkward(copies=12))


@pytest.mark.parametrize("windows", [1, 1 << 18])
def test_periodic_texts_and_partial_overlaps(spark, monkeypatch, windows):
    monkeypatch.setattr(S, "WINDOWS", windows)
    rnd, rows = random.Random(5), []
    pool = ["".join(rnd.choice("abé ") for _ in range(rnd.randrange(40, 130))) for _ in range(6)] + ["x" * 150, "ab" * 80, "abc" * 60]
    for i in range(60):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            s = rnd.choice(pool)
            a = rnd.randrange(20)
            parts += [s[a:len(s) - rnd.randrange(20)], "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(30)))]
        rows.append((i, "".join(parts)))
    check(spark, rows)


def test_suffixes_sort_by_their_bytes():
    rnd = random.Random(1)
    data = np.frombuffer("".join(rnd.choice("ab") for _ in range(400)).encode() + b"ab" * 100 + b"z" * LENGTH, np.uint8)
    raw, at = data.tobytes(), np.arange(0, 600)
    edges = np.array([0, 1, 10, 200, 600])
    order = Suffixes(data).sort(at, edges)
    for a, b in zip(edges[:-1], edges[1:]):
        want = sorted(range(a, b), key=lambda i: (raw[i:i + LENGTH], i))
        assert order[a:b].tolist() == want
    number = Suffixes(data).equal_groups(at, edges)
    groups = np.searchsorted(edges, at, side="right")
    keys = {}
    for i in at:
        assert keys.setdefault((groups[i], raw[i:i + LENGTH]), number[i]) == number[i]
    assert len(set(number)) == len(keys)


def test_colliding_hashes_are_told_apart_by_bytes():
    data = np.frombuffer(b"a" * LENGTH + b"b" * LENGTH + b"a" * LENGTH, np.uint8)
    hashes = hashes_of(data)
    hashes.sums[:] = 0  # every two strings collide
    number = Suffixes(data, hashes).equal_groups(np.array([0, LENGTH, 2 * LENGTH]), np.array([0, 3]))
    assert number[0] == number[2] != number[1]


def test_awkward_rows(spark):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    rows = [(5, text), (5, text), (None, text), (6, "- " + text), (7, None), (8, "")]
    df = documents(spark, rows).withColumn("Kept", F.lit(1)).withColumn("span_id", F.lit(2))
    out = sorted((r["doc_id"] or 99, r["n_removed"], r["Kept_in"]) for r in remove_repeats(df).collect())
    n = len(text)
    assert out == [(5, 0, 1), (5, 0, 1), (6, n, 1), (7, 0, 1), (8, 0, 1), (99, n, 1)]
    assert remove_repeats(documents(spark, [])).count() == 0


def by_bucket(batches):
    """The batches as tasks get them: rows of a bucket together."""
    import pyarrow as pa

    rows = sorted(zip(*(sum((b.column(c).to_pylist() for b in batches), []) for c in ("bucket", "blob", "more"))), key=lambda r: r[0])
    return [pa.record_batch({"bucket": [r[0] for r in rows], "blob": [r[1] for r in rows], "more": [r[2] for r in rows]})]


def asked_for(texts, buckets=3):
    """How many keys the runs of the texts leave for the sort."""
    import pyarrow as pa

    batch = pa.record_batch({"id": pa.array(range(len(texts)), pa.int64()), "tag": pa.array([0] * len(texts), pa.int32()), "text": texts})
    met = list(S._meet(buckets)(by_bucket(list(S._send(buckets)([batch])))))
    return sum(len(blob) // 8 for b in met for kind, blob in zip(b.column("kind").to_pylist(), b.column("blob").to_pylist()) if kind == S.KEYS)


def test_a_common_phrase_alone_is_not_sorted():
    rnd = random.Random(3)

    def among(shared):
        return ["".join(rnd.choice("abcdefghij ") for _ in range(70)) + shared + "".join(rnd.choice("abcdefghij ") for _ in range(70)) for _ in range(300)]

    # An anchor fits into 24 bytes, a string does not.
    assert asked_for(among("as the common phrase, as")) == 0
    assert asked_for(among("as the common phrase of all is, and so on to more than fifty bytes")) > 0


@pytest.mark.parametrize("windows", [1, 1 << 18])
def test_shared_parts_about_as_long_as_a_string(spark, monkeypatch, windows):
    monkeypatch.setattr(S, "WINDOWS", windows)
    monkeypatch.setattr(S, "PIECE", 500)
    rnd, rows = random.Random(11), []

    def noise(n):
        return "".join(rnd.choice("abcdefghé ") for _ in range(n))

    parts = [noise(n) for n in (30, 48, 49, 50, 51, 52, 60, 66, 67, 70, 83, 120)]
    for i in range(90):
        rows.append((i // 2 if i % 9 else None, noise(rnd.randrange(60)) + rnd.choice(parts) + noise(rnd.randrange(60)) + rnd.choice(parts)))
    check(spark, [(k if k is not None else 1000 + i, text) for i, (k, text) in enumerate(rows)])


def test_hashes_of_pieces_are_those_of_the_whole(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 64)
    data = np.frombuffer(random.Random(2).randbytes(64 * 3 + LENGTH + 5), np.uint8)
    at = np.arange(len(data) - LENGTH + 1)
    assert (Suffixes(data).hash(at) == Suffixes(data, hashes_of(data)).hash(at)).all()


def test_sides_of_colliding_hashes_are_told_apart_by_bytes():
    texts = [b"a" * 60, b"b" * 60, b"a" * 60]
    data = np.frombuffer(b"".join(texts), np.uint8)
    rows = np.zeros(3, dtype=S.PART)
    rows["size"], rows["offset"], rows["id"] = 60, 20, [3, 2, 1]
    suffixes = Suffixes(data, hashes_of(data))
    suffixes.hashes.sums[:] = 0  # every two strings collide
    order, new = S._classes(rows, data, np.array([0, 60, 120]), suffixes)
    classes = dict(zip(order.tolist(), np.cumsum(new).tolist()))
    assert classes[0] == classes[2] != classes[1]
