import pytest
from pyspark.sql import functions as F

from opinara.functions.labels import email_label, review_label
from opinara.functions.vocabulary import Vocabulary
from opinara.operators.text import score_sentiment, score_with

# Example sentences and scores published with the model, and the valences they rest on.
PUBLISHED_VALENCES = {
    "smart": 1.7, "handsome": 2.2, "funny": 1.9, "good": 1.9, "horrible": -2.5, "great": 3.1,
    "bad": -2.5, "sux": -1.5, "lol": 1.8, ":)": 2.0, ":d": 2.3, "sure": 1.3}
PUBLISHED = [
    ("VADER is smart, handsome, and funny.", 0.8316),
    ("VADER is smart, handsome, and funny!", 0.8439),
    ("VADER is very smart, handsome, and funny.", 0.8545),
    ("VADER is VERY SMART, handsome, and FUNNY.", 0.9227),
    ("VADER is VERY SMART, handsome, and FUNNY!!!", 0.9342),
    ("VADER is VERY SMART, uber handsome, and FRIGGIN FUNNY!!!", 0.9469),
    ("VADER is not smart, handsome, nor funny.", -0.7424),
    ("The book was good.", 0.4404),
    ("At least it isn't a horrible book.", 0.431),
    ("The book was only kind of good.", 0.3832),
    ("Today SUX!", -0.5461),
    ("Today only kinda sux! But I'll get by, lol", 0.5249),
    ("Make sure you :) or :D today!", 0.8633),
    ("Not bad at all", 0.431),
]


def scores(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = score_sentiment(df, **options).orderBy("id").collect()
    return [None if r["sentiment_score"] is None else round(r["sentiment_score"], 4) for r in rows]


def test_published_examples(spark):
    found = scores(spark, [t for t, _ in PUBLISHED], lexicon=Vocabulary.of(PUBLISHED_VALENCES))
    assert found == [s for _, s in PUBLISHED]


def test_texts_without_opinion(spark):
    assert scores(spark, [None, "", "   ", "!!! ... ?", "plain words only", "a b c"]) == [
        None, 0.0, 0.0, 0.0, 0.0, 0.0]


def norm(total):
    return round(total / (total * total + 15) ** 0.5, 4)


# Total of the judged valences and the emphasis; "bad ass" counts only from the fourth word on.
RULES = [
    ("good good", 3.8),
    ("not good", 1.9 * -0.74),
    ("xx not yy good", 1.9 * -0.74),
    ("not xx yy good", 1.9 * -0.74),
    ("not xx yy zz good", 1.9),
    ("not not good", 1.9 * 0.74 * 0.74),
    ("never so good", (1.9 + 0.293) * 1.5),
    ("wouldn't good", 1.9 * -0.74),
    ("very good", 1.9 + 0.293),
    ("very xx good", 1.9 + 0.293 * 0.95),
    ("very xx yy good", 1.9 + 0.293 * 0.9),
    ("slightly bad", -2.5 + 0.293),
    ("VERY good stuff", 1.9 + 0.293 + 0.733),
    ("GOOD stuff", 1.9 + 0.733),
    ("GOOD STUFF", 1.9),
    ("BAD stuff", -2.5 - 0.733),
    ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
    ("least good", 1.9 * -0.74),
    ("xx least good", 1.9 * -0.74),
    ("at least good", 1.9),
    ("very least good", 1.9 + 0.293 * 0.95),
    ("xx that is yeah right good", -2.0),
    ("xx yy zz bad ass", 1.5),
    ("xx yy bad ass good", -2.5 + 1.5),
    ("xx sort of good", 1.9 - 0.293),
    ("kind of good", 1.9),
    ("good!", 1.9 + 0.292),
    ("good!!!!!!", 0.0),
    ("good !!!!!!", 1.9 + 4 * 0.292),
    ("good ??", 1.9 + 0.36),
    ("good ?????", 1.9 + 0.96),
    ("bad !", -2.5 - 0.292),
    ("(good)", 0.0),
    ("'good", 1.9),
    ("good bad", 1.9 - 2.5),
]


def test_single_rules(spark):
    found = dict(zip([t for t, _ in RULES], scores(spark, [t for t, _ in RULES])))
    assert found == {text: norm(total) for text, total in RULES}


def test_repeated_word_is_judged_where_it_first_stands(spark):
    text = ["good xx yy zz not good"]
    assert scores(spark, text) == [norm(3.8)]
    assert scores(spark, text, context="each") == [norm(1.9 - 1.9 * 0.74)]


def test_joined_lexicon_gives_the_same_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    df = df.unionByName(df.where("doc_id < 20"))
    df = df.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "no hits here")], df.schema))
    words = df.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("token")).where("length(token) > 3")
    table = words.distinct().select("token", ((F.length("token") * 7 + F.ascii("token")) % 17 / 4.0 - 2).alias("valence"))
    inline = Vocabulary.from_table(table, "token", "valence")
    joined = Vocabulary.from_table(table, "token", "valence", max_entries=10)
    assert inline.inline and not joined.inline
    a = sorted(map(tuple, score_sentiment(df, lexicon=inline).select("doc_id", "sentiment_score").collect()))
    b = sorted(map(tuple, score_sentiment(df, lexicon=joined).select("doc_id", "sentiment_score").collect()))
    assert [k for k, _ in a] == [k for k, _ in b] and len(a) == df.count()
    # The same sum; only the order of adding may differ in the last bit.
    assert all(x == y or abs(x - y) < 1e-6 for (_, x), (_, y) in zip(a, b) if x is not None)


def test_scores_stay_in_range_and_keep_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = score_sentiment(df)
    assert rows.columns == df.columns + ["sentiment_score"]
    low, high, n = rows.agg(F.min("sentiment_score"), F.max("sentiment_score"), F.count("*")).first()
    assert -1 <= low <= high <= 1 and n == df.count()


def test_default_plan_has_no_shuffle_and_no_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plan = score_sentiment(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_labels_of_null_differ(spark):
    df = spark.createDataFrame([(0.5,), (-0.5,), (0.0,), (None,)], "s float")
    rows = df.select(email_label(F.col("s")), review_label(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [
        ("Positive", "POSITIVO"), ("Negative", "NEGATIVO"), ("Neutral", "NEUTRO"), ("Neutral", None)]


def test_plugged_in_scorer(spark):
    df = spark.createDataFrame([("ab",), ("",), (None,)], "text string")

    def scorer(texts):
        return [float("nan") if t == "" else len(t) / 10 if t else 0.0 for t in texts]

    assert [r[0] for r in score_with(df, scorer).select("sentiment_score").collect()] == [
        pytest.approx(0.2), None, None]


@pytest.mark.parametrize("kind", ["decimal(3,1)", "float", "int", "double"])
def test_both_forms_take_any_number(spark, kind):
    table = spark.createDataFrame([("good", 2.0), ("bad", -1.0), ("odd", None)], "word string, value double").withColumn("value", F.col("value").cast(kind))
    df = spark.createDataFrame([("good food",), ("bad food",), ("odd",)], "text string")
    scores = []
    for bounds in ({}, {"max_entries": 0}, {"max_entries": 0, "cut_entries": 0}):
        lexicon = Vocabulary.from_table(table, "word", "value", **bounds)
        scores.append(sorted(map(tuple, score_sentiment(df, lexicon=lexicon).collect())))
    assert scores[0] == scores[1] == scores[2] and scores[0][0][1] < 0 < scores[0][1][1]


def test_a_dictionary_is_measured():
    with pytest.raises(ValueError, match="too large"):
        Vocabulary.of({str(i): 1.0 for i in range(60_000)})


def test_a_cut_lexicon_leaves_one_scan_and_no_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    words = df.select(F.explode(F.split(F.lower("text"), " ")).alias("word")).distinct().withColumn("value", F.lit(1.5))
    lexicon = Vocabulary.from_table(words, "word", "value", max_entries=0)
    plan = score_sentiment(df, lexicon=lexicon)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan and "Join" not in plan


def test_rules_are_asked_for_turning_words_only(spark):
    """The words before an opinion meet one set; only whole expressions and the strength of a booster are looked up by hash."""
    df = spark.createDataFrame([("not good",)], "text string")
    plan = score_sentiment(df, lexicon=Vocabulary.of({"good": 1.9}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("crc32") <= 13  # the lexicon, three boosters, nine expressions; 17 with every word before it
    assert "INSET" in plan.upper()


# Words around the edges of the rules, and whether any other word keeps them from applying.
SHOUTS = [("GOOD", 1.9), ("GOOD GOOD", 3.8), ("GOOD day", 1.9 + 0.733), ("DAY good", 1.9), ("DAY GOOD", 1.9), ("VERY good day", 1.9 + 0.293 + 0.733), ("12 GOOD", 1.9 + 0.733)]


def test_capitals_count_where_not_all_words_are_in_capitals(spark):
    assert scores(spark, [t for t, _ in SHOUTS], lexicon=Vocabulary.of({"good": 1.9})) == [norm(v) for _, v in SHOUTS]


def test_a_joined_lexicon_of_small_size_shuffles_no_words(spark):
    table = spark.createDataFrame([(f"w{i}", float(i)) for i in range(1, 50)], "word string, value double")
    texts = spark.createDataFrame([(i, f"w{i}, W{i + 1}. w{i} and x{i}!") for i in range(1, 40)], "id int, text string")
    joined = Vocabulary.from_table(table, "word", "value", max_entries=0, cut_entries=0)
    scored = score_sentiment(texts, lexicon=joined)
    found = {r["id"]: r["sentiment_score"] for r in scored.collect()}
    inline = {r["id"]: r["sentiment_score"] for r in score_sentiment(texts, lexicon=Vocabulary.from_table(table, "word", "value")).collect()}
    assert found == inline
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and "strategy=merge" not in plan
    merged = Vocabulary(table=joined.table, cut_entries=0)
    assert {r["id"]: r["sentiment_score"] for r in score_sentiment(texts, lexicon=merged).collect()} == inline
