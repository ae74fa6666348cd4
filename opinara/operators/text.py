"""Score, detect and translate the texts of a DataFrame.

Each operator adds one column and keeps every row as it is. With a vocabulary of
checked size the added column is a projection: no shuffle, no Python worker.
"""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sentiment, words as W
from ..functions.language import ENGLISH, best_language, glossary_key, in_place_of
from ..functions.text import letter_runs, lower_letters, parts, word, words
from ..functions.vocabulary import Vocabulary, attach, by_text, distinct_words, lookup, text_key


def default_lexicon() -> Vocabulary:
    return Vocabulary.of(W.LEXICON)


def stop_word_vocabulary(table: dict = None) -> Vocabulary:
    """Vocabulary ``word -> languages`` from ``{language: [word]}``."""
    entries = {}
    for lang, listed in sorted((table or W.STOP_WORDS).items()):
        for word in listed:
            entries.setdefault(word, []).append(lang)
    return Vocabulary.of(entries, "array<string>")


def stop_words_from_table(table: DataFrame, lang="lang", word="word", **bounds) -> Vocabulary:
    grouped = table.groupBy(word).agg(F.array_sort(F.collect_set(lang)).alias("langs"))
    return Vocabulary.from_table(grouped, word, "langs", **bounds)


def glossary_vocabulary(table: dict = None) -> Vocabulary:
    """Vocabulary ``language word -> English`` from ``{language: {word: English}}``."""
    entries = {f"{lang} {word}": english
               for lang, listed in (table or W.GLOSSARY).items()
               for word, english in listed.items()}
    return Vocabulary.of(entries, "string")


def glossary_from_table(table: DataFrame, lang="lang", word="word", english="english", **bounds):
    keyed = table.select(glossary_key(F.col(lang), F.col(word)).alias("word"), english)
    return Vocabulary.from_table(keyed, "word", english, **bounds)


def score_sentiment(df: DataFrame, text="text", out="sentiment_score",
                    lexicon: Vocabulary = None, context=sentiment.FIRST) -> DataFrame:
    """Add the sentiment of ``text`` in [-1, 1] as FLOAT; NULL stays NULL."""
    lexicon = lexicon or default_lexicon()
    key = f"{out}__key"

    def lower_word(part):
        return F.lower(word(part))

    if not lexicon.inline:
        lexicon = lexicon.cut(distinct_words(df, parts(F.col(text)), lower_word))

    def score(rows):
        at = sentiment.Stages(out)
        rows, index = attach(rows, lexicon, parts(F.col(text)), key, at.lexicon, lower_word)
        rows = rows.withColumn(at.words, words(F.col(text)))
        rows = rows.withColumn(at.lower, F.transform(at.words, F.lower))
        rows = rows.withColumns({
            at.valence: F.transform(at.lower, lambda w: lookup(index, w).cast("double")),
            at.shout: sentiment.not_all_capitals(at.words),
            at.but_at: F.array_position(at.lower, "but").cast("int"),
            at.idioms: sentiment.may_hold_idioms(at.words),
        })
        rows = rows.withColumn(at.total, sentiment.total(at, context))
        result = sentiment.compound(F.col(at.total), F.col(text)).cast("float")
        return rows.withColumn(out, result).drop(*at.all())

    if lexicon.inline:
        return score(df)
    return by_text(df, key, text_key(F.col(text)), [text], score, out)


def detect_language(df: DataFrame, text="text", out="language",
                    stop_words: Vocabulary = None) -> DataFrame:
    """Add the language code of ``text``; NULL when no stop word tells."""
    stop_words = stop_words or stop_word_vocabulary()
    if not stop_words.inline:
        stop_words = stop_words.cut(distinct_words(df, lower_letters(F.col(text))))
    key, own = f"{out}__key", f"{out}__vocabulary"

    def detect(rows):
        listed = lower_letters(F.col(text))
        rows, index = attach(rows, stop_words, listed, key, own)
        return rows.withColumn(out, best_language(listed, index)).drop(own)

    if stop_words.inline:
        return detect(df)
    return by_text(df, key, text_key(F.col(text)), [text], detect, out)


def translate(df: DataFrame, text="text", out="translated", lang=None,
              glossary: Vocabulary = None, stop_words: Vocabulary = None) -> DataFrame:
    """Add ``text`` in English. English, undetected and untranslatable text stays as it is.

    ``lang`` names a column that holds the language; without it the language is
    detected first.
    """
    glossary = glossary or glossary_vocabulary()
    code = lang or f"{out}__language"
    key, source, pieces, keys, found, own = (
        f"{out}__{stage}" for stage in ("key", "source", "pieces", "keys", "found", "vocabulary"))

    def asked(run):
        return glossary_key(F.col(code), run)

    def known(rows):
        return rows if lang else detect_language(rows, text, code, stop_words)

    if not glossary.inline:
        # A filter by the language would be pushed down to where the language is found, and find it again.
        foreign = F.when(F.col(code) != ENGLISH, letter_runs(F.col(text)))
        glossary = glossary.cut(distinct_words(known(df.select(text, *([lang] if lang else []))), foreign, asked, reads=[code]))

    def turn(rows):
        rows = known(rows)
        rows = rows.withColumn(source, F.when(F.col(code) != ENGLISH, F.col(text)))
        rows, index = attach(rows, glossary, letter_runs(F.col(source)), key, own, asked, [code])
        rows = rows.withColumn(pieces, letter_runs(F.col(source)))
        rows = rows.withColumn(keys, F.transform(pieces, asked))
        rows = rows.withColumn(found, F.transform(keys, lambda k: lookup(index, k)))
        english = F.transform(pieces, lambda p, i: in_place_of(p, F.get(found, i)))
        rows = rows.withColumn(out, F.coalesce(F.array_join(english, ""), F.col(text)))
        return rows.drop(source, pieces, keys, found, own)

    if glossary.inline:
        df = turn(df)
    else:
        # The language is found once for each distinct text, along with its translation.
        digest = _translation_key(lang, text) if lang else text_key(F.col(text))
        df = by_text(df, key, digest, list(dict.fromkeys([text, lang or text])), turn, out)
    return df if lang else df.drop(code)


def _translation_key(code, text):
    return text_key(F.coalesce(F.col(code), F.lit("")), F.lit("\n"), F.col(text))


def _each_or_none(translator, texts, langs):
    """Results of ``translator``; None for each text it fails on. A failing batch is halved down to single texts."""
    try:
        found = list(translator(texts, langs))
        if len(found) == len(texts):
            return found
    except Exception:
        pass
    if len(texts) <= 1:
        return [None] * len(texts)
    half = len(texts) // 2
    return [result for part in (slice(0, half), slice(half, None))
            for result in _each_or_none(translator, texts.iloc[part].reset_index(drop=True), langs.iloc[part].reset_index(drop=True))]


def translate_with(df: DataFrame, translator, text="text", out="translated",
                   lang=None, stop_words: Vocabulary = None, ok: str = None) -> DataFrame:
    """Translate foreign text with a caller's ``translator(texts, languages) -> texts``.

    It gets pandas batches of distinct foreign texts. A text that it raises on or
    gives no result for keeps the original; the others of its batch are translated
    all the same. ``ok`` names a column that says so: false for a foreign text that
    kept the original, true for a translated one, missing where nothing was asked.
    """
    code = lang or f"{out}__language"
    key = f"{out}__key"
    if lang is None:
        df = detect_language(df, text, code, stop_words)

    def call(batches):
        for batch in batches:
            found = _each_or_none(translator, batch[text], batch[code])
            yield pd.DataFrame({key: batch[key].values, out: pd.Series(found, dtype="object").values})

    def turn(rows):
        return rows.where(F.col(code) != ENGLISH).mapInPandas(call, f"`{key}` binary, `{out}` string")

    df = by_text(df, key, _translation_key(code, text), [text, code], turn, out)
    if ok:
        df = df.withColumn(ok, F.when((F.col(code) != ENGLISH) & F.col(text).isNotNull(), F.col(out).isNotNull()))
    df = df.withColumn(out, F.coalesce(F.col(out), F.col(text)))
    return df if lang else df.drop(code)


def score_with(df: DataFrame, scorer, text="text", out="sentiment_score") -> DataFrame:
    """Score with a caller's ``scorer(texts) -> numbers`` in pandas batches; NaN becomes NULL."""
    @F.pandas_udf("float")
    def call(texts: pd.Series) -> pd.Series:
        return pd.Series(scorer(texts), dtype="float32")

    score = F.when(F.col(text).isNotNull(), call(text))
    return df.withColumn(out, score).withColumn(out, F.nanvl(F.col(out), F.lit(None).cast("float")))
