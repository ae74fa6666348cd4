import sys

from pyspark.sql import functions as F

from opinara.functions import words as W
from opinara.functions.text import letter_runs, parts, word, words
from opinara.functions.vocabulary import Vocabulary, distinct_words
from opinara.operators.text import (detect_language, glossary_from_table, stop_words_from_table,
                                    translate, translate_with)


def test_every_white_space_separates_words(spark):
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    others = ["​", "᠎", "﻿", "⁠", "\x1b", " x"]
    df = spark.createDataFrame([(c, f"ab{c}cd") for c in spaces + others], "c string, text string")
    for row in df.select("c", words(F.col("text")).alias("w")).collect():
        assert row["w"] == f"ab{row['c']}cd".split(), repr(row["c"])


def plain(word):
    import string
    return len(word) > 1 and not any(c in string.punctuation for c in word)


def brute_words(text):
    found = []
    for w in text.split():
        if len(w) < 2:
            continue
        for mark in W.EDGE_PUNCTUATION:
            if w.endswith(mark) and plain(w[:-len(mark)]):
                w = w[:-len(mark)]
                break
            if w.startswith(mark) and plain(w[len(mark):]):
                w = w[len(mark):]
                break
        found.append(w)
    return found


def test_words_against_brute_force(spark):
    parts = ["good", "a", "don't", "well-known", "éau", "x_y", ":)", "--", "😀😀", "I"]
    marks = W.EDGE_PUNCTUATION + ["(", "!!!!", "...", "", "_"]
    texts = [f"{a}{p}{b} {p}" for a in marks for p in parts for b in marks]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in df.select("text", words(F.col("text")).alias("w")).collect():
        assert row["w"] == brute_words(row["text"]), row["text"]


def test_letter_runs_join_to_the_text(spark):
    texts = ["", "Où est-il ?", "a1b2", " 你好, été   x", "'quoted' 😀"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in df.select("text", letter_runs(F.col("text")).alias("r")).collect():
        assert "".join(row["r"]) == row["text"]


def test_detection_and_translation(spark):
    df = spark.createDataFrame([
        (1, "Le service est TRÈS bon, mais lent."), (2, "the service is good and it is fast"),
        (3, "xyzzy"), (4, None), (5, ""), (6, "Der Dienst ist sehr schlecht")], "id int, text string")
    rows = {r["id"]: r for r in translate(detect_language(df), lang="language").collect()}
    assert [rows[i]["language"] for i in range(1, 7)] == ["fr", "en", None, None, None, "de"]
    assert rows[1]["translated"] == "The service is VERY good, but slow."
    assert rows[6]["translated"] == "The Service is very bad"
    for i in (2, 3, 4, 5):
        assert rows[i]["translated"] == rows[i]["text"]
    assert rows[1].asDict().keys() == {"id", "text", "language", "translated"}


def test_tie_takes_the_code_that_sorts_last(spark):
    df = spark.createDataFrame([("que que le les",)], "text string")
    # "que" is French and Spanish; one more word on each side.
    found = detect_language(df, stop_words=Vocabulary.of(
        {"que": ["es", "fr"], "le": ["es"], "les": ["fr"]}, "array<string>"))
    assert found.first()["language"] == "fr"


def test_tables_give_the_same_as_the_built_in_lists(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    df = df.unionByName(spark.createDataFrame([(-1, None), (-2, "")], df.schema))
    stop = spark.createDataFrame([(k, w) for k, v in W.STOP_WORDS.items() for w in v], "lang string, word string")
    glossary = spark.createDataFrame(
        [(k, w, e) for k, v in W.GLOSSARY.items() for w, e in v.items()], "lang string, word string, english string")
    expected = sorted(translate(detect_language(df), lang="language").collect(), key=str)
    for bounds in ({}, {"max_entries": 5}, {"max_entries": 5, "cut_entries": 5}):
        found = translate(detect_language(df, stop_words=stop_words_from_table(stop, **bounds)), lang="language",
                          glossary=glossary_from_table(glossary, **bounds))
        assert sorted(found.select(*df.columns, "language", "translated").collect(), key=str) == expected


def test_failing_translator_keeps_the_text(spark):
    df = spark.createDataFrame([("le service est lent et la vie",), ("the cat is on it",), (None,)], "text string")

    def broken(texts, langs):
        raise RuntimeError("no connection")

    def upper(texts, langs):
        return texts.str.upper()

    df = df.unionByName(df)
    for translator, first in ((broken, "le service est lent et la vie"), (upper, "LE SERVICE EST LENT ET LA VIE")):
        found = translate_with(df, translator)
        assert found.columns == ["text", "translated"]
        assert sorted((r["translated"] for r in found.collect()), key=str) == sorted(
            2 * [first, "the cat is on it", None], key=str)


def test_only_the_texts_that_fail_stay(spark):
    foreign = [f"le service est lent et la vie {i}" for i in range(20)]
    df = spark.createDataFrame([(t,) for t in [*foreign, "the cat is on it", None]], "text string").coalesce(1)

    def picky(texts, langs):
        if texts.str.contains(" 7").any():
            raise RuntimeError("no")
        return texts.str.upper()

    def short(texts, langs):
        return list(texts.str.upper())[:1]

    found = {r["text"]: (r["translated"], r["ok"]) for r in translate_with(df, picky, ok="ok").collect()}
    assert found == {**{t: (t, False) if t.endswith(" 7") else (t.upper(), True) for t in foreign},
                     "the cat is on it": ("the cat is on it", None), None: (None, None)}
    assert {r["translated"] for r in translate_with(df, short).collect()} == {*(t.upper() for t in foreign), "the cat is on it", None}


def test_translator_sees_every_foreign_text_once(spark):
    rows = 300 * [("le service est lent",)] + 200 * [("the cat is on it",)] + [("der Hund ist nicht da",)]
    df = spark.createDataFrame(rows, "text string").repartition(5)

    def count(texts, langs):
        assert len(set(texts)) == len(texts) and not texts.str.contains("cat").any()
        return langs + ":" + texts

    found = translate_with(df, count).groupBy("translated").count().collect()
    assert {r["translated"]: r["count"] for r in found} == {
        "fr:le service est lent": 300, "the cat is on it": 200, "de:der Hund ist nicht da": 1}


def test_default_plans_stay_in_the_row(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plan = translate(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_word_tables_stay_small():
    assert len(W.LEXICON) < 200 and sum(map(len, W.GLOSSARY.values())) < 200


def test_asked_words_are_made_once_for_each_spelling(spark):
    df = spark.createDataFrame([(1, "one One. one. a one"), (2, None)], "word int, text string")
    asked = distinct_words(df, parts(F.col("text")), lambda p: F.concat(F.col("word"), word(p)), reads=["word"])
    assert sorted(r["word"] for r in asked.collect()) == ["1One", "1one", "1one"]
    plain = distinct_words(df, parts(F.col("text")), word)
    assert sorted(r["word"] for r in plain.collect()) == ["One", "one", "one"]


def test_cutting_a_glossary_finds_each_language_once(spark, monkeypatch):
    plans, plain = [], Vocabulary.cut

    def cut(vocabulary, asked):
        plans.append(asked._jdf.queryExecution().executedPlan().toString())
        return plain(vocabulary, asked)

    monkeypatch.setattr(Vocabulary, "cut", cut)
    rows = [(1, "le film est bon et la fin"), (2, "the film is good"), (3, "xyz"), (4, None)]
    df = spark.createDataFrame(rows, "id int, text string")
    listed = [(lang, word, english) for lang, own in W.GLOSSARY.items() for word, english in own.items()]
    table = spark.createDataFrame(listed, "lang string, word string, english string")
    expected = {r["id"]: r["translated"] for r in translate(df).collect()}
    assert expected[1] != rows[0][1] and expected[2] == rows[1][1]
    for bounds in ({"max_entries": 1}, {"max_entries": 1, "cut_entries": 1}):
        out = translate(df, glossary=glossary_from_table(table, **bounds))
        assert {r["id"]: r["translated"] for r in out.collect()} == expected
    assert [plan.count("regexp_extract_all(lower(") for plan in plans] == [1, 1]
