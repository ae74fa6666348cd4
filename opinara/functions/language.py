"""Detect a text's language by its stop words and translate it by a glossary."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import let, lookup

ENGLISH = "en"


def best_language(words: Column, stop_words: Column) -> Column:
    """Language with most stop words in the text; NULL when there are none.

    ``stop_words`` gives the array of languages a word belongs to. Of equal
    counts the code that sorts last wins, so the answer does not depend on order.
    """
    langs = F.flatten(F.filter(
        F.transform(words, lambda w: lookup(stop_words, w)), lambda a: a.isNotNull()))

    def best(found):
        ranked = F.transform(F.array_distinct(found), lambda code: F.struct(
            F.size(F.filter(found, lambda c: c == code)).alias("n"), code.alias("lang")))
        return F.array_max(ranked)["lang"]

    return let(langs, best)


def glossary_key(lang: Column, word: Column) -> Column:
    return F.concat(lang, F.lit(" "), F.lower(word))


def in_place_of(word: Column, english: Column) -> Column:
    """``english`` with the capitals of the word it replaces; the word itself when NULL."""
    first = F.substring(word, 1, 1)
    capital = F.concat(F.upper(F.substring(english, 1, 1)), F.substring(english, 2, 1 << 30))
    return (F.when(english.isNull(), word)
            .when((F.length(word) > 1) & (word == F.upper(word)), F.upper(english))
            .when(first != F.lower(first), capital).otherwise(english))
