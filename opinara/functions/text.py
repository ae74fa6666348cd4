"""Split texts into words."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .words import EDGE_PUNCTUATION

# Unicode white space. The rare characters stand in a nested class behind one range
# test, so that an ordinary character is settled by few tests.
SPACE = (r"[\s\x1c\x1d\x1e\x1f\x85\xa0"
         r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]")
ASCII_PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
EDGE = "^(?:" + "|".join(
    "".join(f"[{c}]" for c in mark) for mark in EDGE_PUNCTUATION) + ")$"
EDGE_CHARACTERS = "".join(sorted(set("".join(EDGE_PUNCTUATION))))


def _is_plain(word: Column) -> Column:
    return (F.length(word) > 1) & (F.translate(word, ASCII_PUNCTUATION, "") == word)


def _without_edge(word: Column) -> Column:
    marks = F.lit(EDGE_CHARACTERS)
    head, tail = F.rtrim(word, marks), F.ltrim(word, marks)
    after = F.substr(word, F.length(head) + 1)
    before = F.substr(word, F.lit(1), F.length(word) - F.length(tail))
    # The first test settles most words; the others run for marked words only.
    return (F.when(F.btrim(word, marks) == word, word)
            .when(after.rlike(EDGE) & _is_plain(head), head)
            .when(before.rlike(EDGE) & _is_plain(tail), tail)
            .otherwise(word))


def words(text: Column) -> Column:
    """White-space separated words of two characters or more.

    One punctuation mark of the fixed list is taken off one end of a plain word;
    every other spelling (emoticons, contractions, hyphens) stays as written.
    """
    return F.transform(F.filter(parts(text), lambda w: F.length(w) > 1), _without_edge)


def parts(text: Column) -> Column:
    """What stands between white space; ``word`` makes each a word."""
    return F.split(text, f"{SPACE}+")


def word(part: Column) -> Column:
    """The word of ``words`` that ``part`` holds, NULL when it is too short."""
    return F.when(F.length(part) > 1, _without_edge(part))


def letter_runs(text: Column) -> Column:
    """Cut a text into runs of letters and runs of everything else; joined they give it back."""
    return F.regexp_extract_all(text, F.lit(r"([\p{L}\p{M}]+|[^\p{L}\p{M}]+)"), F.lit(1))


def lower_letters(text: Column) -> Column:
    """The lower-cased runs of letters of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{M}]+)"), F.lit(1))
