import random

import numpy as np
import public_tokenizers
import tiktoken
from brute import sha
from fixtures import awkward, documents
from pyspark.sql import functions as F

from opinara.llm import bpe
from opinara.llm.bpe import Coder, encode_documents, halves, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = read_ranks(PATH)
TRUE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_random_texts_encode_as_the_library_does():
    coder, rnd, tokens = Coder(RANKS, halves(PATH), public_tokenizers.PATTERN), random.Random(3), list(RANKS)
    texts = ["".join(rnd.choice("abcdeéñüthe inoß🙂中 \n'") for _ in range(rnd.randrange(40))) for _ in range(3000)]
    texts += [b"".join(rnd.choices(tokens, k=rnd.randrange(1, 7))).decode("utf-8", "ignore") for _ in range(3000)]
    texts += ["a" * 30_000, "ab" * 20_000, " " * 9000, "the" * 3000, "0123456789" * 500]
    for text in texts:
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == TRUE.encode_ordinary(text), text[:50]
        assert coder.decode(ids) == text.encode()


def test_documents(spark):
    rows = [*awkward(), (1, "same"), (1, "same"), (None, "<|endoftext|>")]
    df = documents(spark, rows).withColumn("IDS", F.lit(3)).withColumn("_coded", F.lit(4)).withColumn("coded", F.lit(5))
    out = encode_documents(df, PATH, public_tokenizers.PATTERN).collect()
    assert len(out) == len(rows) and all((r["IDS_in"], r["_coded"], r["coded"]) == (3, 4, 5) for r in out)
    for r in out:
        want = TRUE.encode_ordinary(r["text"] or "")
        assert (r["n_tokens"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) == (len(want), want)
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    digests = encode_documents(df, PATH, public_tokenizers.PATTERN, digests=True).select("text", "decoded_sha256").collect()
    assert all(r[1] == sha(r[0] or "") for r in digests)
    assert encode_documents(documents(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_rows_beyond_one_piece_keep_their_ids(spark, monkeypatch):
    """Ids go back in pieces of a batch: every row gets its own, whatever the size of a piece."""
    texts = [None if i % 7 == 0 else f"row {i} of many" for i in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(bpe, "ROWS_AT_ONCE", 8)
    rows = bpe.encode_documents(df, PATH, public_tokenizers.PATTERN).collect()
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in rows} == {i: t or "" for i, t in enumerate(texts)}
