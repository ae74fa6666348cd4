import corpus_pipeline
import public_tokenizers
import tiktoken
from brute import near, lines
from fixtures import awkward, documents

from opinara.llm.bpe import read_ranks
from opinara.llm.common import materialise
from opinara.llm.toxicity import score, train

SF = "/root/testdata/sf0.001"


def test_stages_act_on_what_the_last_one_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "mixing", "encoding"]
    columns = docs.columns

    clean = stages["toxicity"](spark, docs, SF)
    kept = {r["doc_id"] for r in score(docs, train(docs, labels)).where("predicted = 0").collect()}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == kept

    cut = stages["line_dedup"](spark, clean, SF)
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    want = lines(rows)
    assert cut.columns == columns and {r["doc_id"]: r["text"] for r in cut.collect()} == {i: w[2] for i, w in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect() if want[r["doc_id"]][1])

    single = stages["near_dedup"](spark, cut, SF)
    groups = near([(r["doc_id"], r["text"]) for r in cut.collect()], 5, 80)
    assert {r["doc_id"] for r in single.collect()} == {i for i, (_, root) in groups.items() if i == root}

    mixed = stages["mixing"](spark, single, SF)
    assert mixed.columns == columns and {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in single.collect()}

    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    true = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    out = stages["encoding"](spark, mixed, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert len(out) == mixed.count() and all(r["round_trip"] and r["n_tokens"] == len(true.encode_ordinary(texts[r["doc_id"]])) for r in out)


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "round_trip"] and out.count() > 0


def test_awkward_and_empty_documents_pass_all_stages(spark):
    for rows in ([], [*awkward(), (None, "null id"), (1, "twice"), (1, "twice")]):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, SF), name)
        assert docs.where("NOT round_trip").count() == 0


def test_a_worker_keeps_no_coder_in_other_stages():
    import pyarrow as pa

    from opinara.llm import bpe, lines, toxicity  # noqa: F401

    batch = pa.RecordBatch.from_pydict({"text": ["a b a"], "toxic": pa.array([1], pa.int32())})
    bpe._coders["vocabulary"] = object()
    assert list(toxicity._count(2)(iter([batch])))
    assert not bpe._coders
