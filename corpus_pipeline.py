"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Every stage but the last returns the columns of ``documents``. The last returns
the tokens: ``doc_id, source, n_tokens, ids`` (little-endian 32-bit) and whether
they decode to the text (``round_trip``).
"""

import public_tokenizers
from pyspark.sql import functions as F

from opinara.llm.bpe import encode_documents
from opinara.llm.common import table
from opinara.llm.lines import dedup_lines
from opinara.llm.minhash import drop_near_duplicates
from opinara.llm.mixing import copied, mix
from opinara.llm.toxicity import drop_toxic, train
from opinara.session import work_folder

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def toxicity(spark, docs, sf_dir):
    """Documents that the models of toxic and ordinary text do not reject."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def line_dedup(spark, docs, sf_dir):
    """All documents, without the lines that match an earlier one; ``n_chars`` follows the text."""
    cut = dedup_lines(docs)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates, by five-word shingles and a similarity of 0.8."""
    return drop_near_duplicates(docs, k=5, percent=80)


def mixing(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them."""
    return copied(mix(docs)).select(docs.columns)


def encoding(spark, docs, sf_dir):
    """Token ids of every document taken."""
    coded = encode_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "source", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("encoding", encoding)]

# SQL can express neither the models nor the random mix; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = work_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
