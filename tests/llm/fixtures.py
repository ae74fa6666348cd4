"""Documents with the awkward cases, and names for clashing columns."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def sentence(rnd, n, words=300):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


def awkward(seed=1, copies=40):
    """Rows ``(doc_id, text)`` with distinct ids: nulls, empties, long texts, copies, near copies and shared lines."""
    rnd = random.Random(seed)
    base = sentence(rnd, 120)
    shared = sentence(rnd, 14)
    texts = [None, "", " \t\n ", "one", "one two", "ONE two", "İstanbul ÉTÉ straße", "a b 🙂 🙂", "x" * 5000, "ab " * 4000,
             "\n".join([shared] * 3), shared.upper(), base, base.upper(), base]
    for _ in range(copies):
        words = base.split(" ")
        for _ in range(rnd.randrange(1, 5)):
            words[rnd.randrange(len(words))] = f"n{rnd.randrange(10_000)}"
        texts.append(" ".join(words))
        cut = shared.split(" ")
        cut[rnd.randrange(len(cut))] = f"n{rnd.randrange(50)}"
        texts.append(sentence(rnd, 30) + "\n" + " ".join(cut) + "\n" + sentence(rnd, rnd.randrange(1, 6), 8))
    texts += [sentence(rnd, 4000, 2000), "\n".join(sentence(rnd, 9, 40) for _ in range(300))]
    ids = rnd.sample(range(1000), len(texts))
    return list(zip(ids, texts))


def documents(spark, rows):
    """A frame of ``(doc_id, text)`` rows with the other columns of documents."""
    full = [(i, text, "en", None if k % 7 == 0 else f"s{k % 3}", None if text is None else len(text)) for k, (i, text) in enumerate(rows)]
    return spark.createDataFrame(full, DOCUMENTS).repartition(3)


def morse(n):
    """Two different words of ``n`` letters whose polynomial hashes are equal for any base."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))
