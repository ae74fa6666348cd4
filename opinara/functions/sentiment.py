"""Sentiment of a text by the published VADER rules, as column expressions.

Everything happens inside the row: the text's words meet the lexicon by hash
probe, each opinion word is judged in its context, and the sum is normalised to
[-1, 1]. There is no key to group by, so copies of a row or a hot id cost
nothing extra, and a text is never cut.

The rules read these columns, which ``Stages`` names after the score column:

``words``    the words as written
``lower``    the same, lower-cased
``valence``  lexicon value at each position, NULL where there is none
``shout``    true when not all words are in capitals
``but_at``   position of the first "but", 0 when absent
``idioms``   true when a word stands there that every expression of several words needs
``total``    sum of the judged valences
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import words as W
from .vocabulary import Vocabulary, let, lookup

FIRST = "first"
EACH = "each"


def is_upper(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


class Stages:
    """Names of the columns between a text and its score."""

    def __init__(self, out: str):
        for name in ("words", "lower", "lexicon", "valence", "shout", "but_at", "idioms", "total"):
            setattr(self, name, f"{out}__{name}")

    def all(self):
        return list(vars(self).values())


def not_all_capitals(words: str) -> Column:
    # Asked about words in capitals only, so some are. The first word that is not ends the search.
    return F.exists(words, lambda w: ~is_upper(w))


def _joined(*parts):
    return F.concat_ws(" ", *parts)


LAST_OF_IDIOMS = sorted({i.split()[-1] for i in W.IDIOMS})
FIRST_OF_PAIRS = sorted({p.split()[0] for p in W.WEAKENING_PAIRS})
# One probe for each word before an opinion; the rules themselves run for those it finds.
TURNING = sorted({*W.BOOSTERS, *W.NEGATORS})


def may_hold_idioms(words: str) -> Column:
    return F.arrays_overlap(words, F.array(*map(F.lit, sorted({*LAST_OF_IDIOMS, *FIRST_OF_PAIRS}))))


class Context:
    """The words around position ``at`` of one text, and the rules that read them."""

    def __init__(self, stages: Stages, at: Column, boosters: Column, idioms: Column):
        self.stages = stages
        self.at = at
        self.boosters = boosters
        self.idioms = idioms
        self.cells = {}

    def word(self, offset):
        return self._get(self.stages.words, offset)

    def lower(self, offset):
        return self._get(self.stages.lower, offset)

    def _get(self, array, offset):
        # A negative index reads NULL: there is no word before the first.
        if (array, offset) not in self.cells:
            self.cells[array, offset] = F.get(F.col(array), self.at + F.lit(offset))
        return self.cells[array, offset]

    def plain(self, offset):
        """A word stands there and the lexicon does not hold it."""
        return self.word(offset).isNotNull() & self._get(self.stages.valence, offset).isNull()

    def is_modifier(self):
        """The word strengthens or weakens others, so it has no sentiment of its own."""
        kind_of = (self.lower(0) == "kind") & F.coalesce(self.lower(1) == "of", F.lit(False))
        return kind_of | self.lower(0).isin(*W.BOOSTERS)

    def with_capitals(self, valence):
        step = F.when(valence > 0, F.lit(W.CAPS)).otherwise(F.lit(-W.CAPS))
        return F.when(F.col(self.stages.shout) & is_upper(self.word(0)), valence + step).otherwise(valence)

    def shift(self, distance, valence):
        """What the word ``distance`` before adds to the valence."""
        sign = F.when(valence < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        loud = F.when(
            F.col(self.stages.shout) & is_upper(self.word(-distance)),
            F.when(valence > 0, F.lit(W.CAPS)).otherwise(F.lit(-W.CAPS)),
        ).otherwise(F.lit(0.0))
        boost = lookup(self.boosters, self.lower(-distance))
        return F.coalesce((boost * sign + loud) * F.lit(W.DECAY[distance - 1]), F.lit(0.0))

    def factor(self, distance):
        """What the word ``distance`` before multiplies the valence by."""
        low = self.lower(-distance)
        turned = F.when(low.isin(W.NEGATORS) | low.contains("n't"), F.lit(W.NEGATE)).otherwise(F.lit(1.0))
        if distance == 1:
            return turned
        near = self.word(-1).isin("so", "this")
        if distance == 2:
            return F.when((self.word(-2) == "never") & near, F.lit(1.5)).otherwise(turned)
        middle = self.word(-2).isin("so", "this")
        return F.when(((self.word(-3) == "never") & middle) | near, F.lit(1.25)).otherwise(turned)

    def turns(self, distance):
        """A plain word stands there that may change the valence, or the rule for it reads one nearer by."""
        low = self.lower(-distance)
        found = low.isin(TURNING) | low.contains("n't")
        if distance == 3:
            found |= self.word(-1).isin("so", "this")
        return self.plain(-distance) & found

    def after_words(self, valence):
        """What the three words before make of the valence, the nearest first."""
        value = valence
        for distance in (1, 2, 3):
            value = let(value, lambda v: self.after_word(distance, v))
        return F.when(self.turns(1) | self.turns(2) | self.turns(3), value).otherwise(valence)

    def after_word(self, distance, valence):
        changed = (valence + self.shift(distance, valence)) * self.factor(distance)
        return F.when(self.plain(-distance), changed).otherwise(valence)

    def after_idioms(self, valence):
        """Whole expressions replace the valence; a weakening pair before it lowers it."""
        def idiom(*offsets):
            return lookup(self.idioms, _joined(*(self.word(o) for o in offsets)))

        before = F.coalesce(idiom(-1, 0), idiom(-2, -1, 0), idiom(-2, -1),
                            idiom(-3, -2, -1), idiom(-3, -2))
        behind = F.coalesce(idiom(0, 1, 2), idiom(0, 1))
        weak = F.coalesce(lookup(self.boosters, _joined(self.word(-3), self.word(-2))),
                          lookup(self.boosters, _joined(self.word(-2), self.word(-1))))
        changed = (F.coalesce(behind, before, valence)
                   + F.when(weak.isNotNull(), F.lit(-W.BOOST)).otherwise(F.lit(0.0)))
        # Where the last word of an expression can stand, and the first of a pair.
        near = [self.word(o).isin(LAST_OF_IDIOMS) for o in (-2, -1, 0, 1, 2)]
        near += [self.word(o).isin(FIRST_OF_PAIRS) for o in (-3, -2)]
        found = F.col(self.stages.idioms) & self.plain(-3) & reduce(or_, (F.coalesce(n, F.lit(False)) for n in near))
        return F.when(found, changed).otherwise(valence)

    def after_least(self, valence):
        """"least" turns the sign, unless it is "at least" or "very least"."""
        kept = F.coalesce(self.lower(-2).isin("at", "very"), F.lit(False))
        turned = self.plain(-1) & (self.lower(-1) == "least") & ~kept
        return F.when(turned, valence * F.lit(W.NEGATE)).otherwise(valence)

    def valence(self):
        value = self.with_capitals(self._get(self.stages.valence, 0))
        value = let(value, self.after_words)
        value = let(value, lambda v: self.after_idioms(v))
        value = let(value, lambda v: self.after_least(v))
        return F.when(self.is_modifier(), F.lit(0.0)).otherwise(value)


def but_weight(but_at: str, at: Column) -> Column:
    """Opinions before the first "but" count half, those after it half as much again."""
    but = F.col(but_at) - 1
    return (F.when((but < 0) | (at == but), F.lit(1.0))
            .when(at < but, F.lit(0.5)).otherwise(F.lit(1.5)))


def total(stages: Stages, context: str) -> Column:
    """Sum of the judged valences over the opinion words of the text.

    With ``context="first"`` every repetition of a word is judged where the word
    first stands in the text, as the analyzer behind the original jobs does; with
    ``"each"`` where it stands itself. Sorting the opinion words by spelling and
    position lets one pass judge each spelling once.
    """
    tables = [Vocabulary.of(entries).constant()
              for entries in (W.BOOSTERS, W.IDIOMS)]
    # Without words the places run from 0 to -1, and neither has a value.
    places = F.sequence(F.lit(0), F.size(stages.valence) - 1)
    hits = F.transform(F.filter(places, lambda i: F.get(stages.valence, i).isNotNull()),
                       lambda i: F.struct(F.get(stages.words, i).alias("word"), i.alias("at")))
    if context == EACH:
        judged = F.transform(
            hits, lambda h: Context(stages, h["at"], *tables).valence() * but_weight(stages.but_at, h["at"]))
        return F.aggregate(judged, F.lit(0.0), lambda a, v: a + v)

    def step(done, hit):
        value = F.when(done["word"] == hit["word"], done["value"]).otherwise(
            Context(stages, hit["at"], *tables).valence())
        return let(value, lambda v: F.struct(
            hit["word"].alias("word"), v.alias("value"),
            (done["sum"] + v * but_weight(stages.but_at, hit["at"])).alias("sum")))

    start = F.struct(F.lit(None).cast("string").alias("word"),
                     F.lit(0.0).alias("value"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.sort_array(hits), start, step)["sum"]


def punctuation(text: Column) -> Column:
    """Emphasis of the text's exclamation and question marks."""
    def count(mark):
        return F.length(text) - F.length(F.replace(text, F.lit(mark)))

    bangs = F.least(count("!"), F.lit(4)) * F.lit(W.EXCLAMATION)
    asks = count("?")
    asked = (F.when(asks <= 1, F.lit(0.0))
             .when(asks <= 3, asks * F.lit(W.QUESTION)).otherwise(F.lit(W.QUESTION_MANY)))
    return bangs + asked


def compound(total: Column, text: Column) -> Column:
    """Total and emphasis brought to [-1, 1], four decimals.

    The total is rounded first, so that opinions that cancel out give exactly
    zero in whatever order they were added.
    """
    total = F.round(total, 9)
    loud = total + F.signum(total) * punctuation(text)
    return F.round(loud / F.sqrt(loud * loud + F.lit(W.ALPHA)), 4)
