"""Look up words of an array in a vocabulary, one hash probe per word.

A vocabulary is an array of small maps; a word lives in the map at
``crc32(word) % size``. A vocabulary of checked size becomes one constant of the
plan, so a look-up needs neither join nor shuffle. A larger one stays a table. Before
it is used it is cut to the words that the texts hold; what is left is nearly always
small enough for a constant. If it is not, ``attach`` joins its entries to the
distinct texts that use them, and each of these carries a vocabulary of just its own
words. Look-ups read the same in any form.
"""

import json
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

MAX_INLINE_ENTRIES = 50_000
MAX_INLINE_BYTES = 2 << 20
MAX_SENT_BYTES = 8 << 20


class Vocabulary:
    """Words and their values, held as a constant or, beyond the bound, as a table."""

    def __init__(self, entries=None, table=None, value_type="double", cut_entries=MAX_INLINE_ENTRIES, sent=False):
        self.entries = entries
        self.table = table
        self.sent = sent
        self.value_type = value_type
        self.cut_entries = cut_entries

    @property
    def inline(self):
        return self.entries is not None

    @classmethod
    def of(cls, entries: dict, value_type="double"):
        """A dictionary of the caller's as a constant; one beyond the bounds has to come as a table."""
        size = sum(len(word.encode()) + len(json.dumps({"value": value})) for word, value in entries.items())
        if len(entries) > MAX_INLINE_ENTRIES or size > MAX_INLINE_BYTES:
            raise ValueError("too large for a constant: give it as a table, with Vocabulary.from_table")
        return cls(entries=entries, value_type=value_type)

    @classmethod
    def from_table(cls, table: DataFrame, word: str, value: str,
                   max_entries=MAX_INLINE_ENTRIES, max_bytes=MAX_INLINE_BYTES, cut_entries=MAX_INLINE_ENTRIES):
        """Measure ``table``; keep it inline only if rows and bytes stay within the bounds.

        A word listed twice keeps its greatest value, whichever form is chosen. Numbers
        of any type become doubles first, so that both forms look up the same.
        """
        if isinstance(table.schema[value].dataType, NumericType):
            table = table.withColumn(value, F.col(value).cast("double"))
        table = (table.where(F.col(word).isNotNull() & F.col(value).isNotNull())
                 .groupBy(F.col(word).alias("word")).agg(F.max(value).alias("value")))
        value_type = table.schema["value"].dataType.simpleString()
        bytes_ = F.octet_length("word") + F.octet_length(F.to_json(F.struct("value")))
        n, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(bytes_), F.lit(0))).first()
        if n <= max_entries and size <= max_bytes:
            entries = {r["word"]: r["value"] for r in table.collect()}
            return cls(entries=entries, value_type=value_type)
        return cls(table=table, value_type=value_type, cut_entries=cut_entries, sent=size <= MAX_SENT_BYTES)

    def found_in(self, words: DataFrame) -> DataFrame:
        """Rows of ``words`` whose ``word`` is listed, with its ``value``.

        A table that measured small goes to every task, so the words of the texts need no
        shuffle. A larger one is merged: its hot words are split by adaptive execution. The
        words look small to the planner before they are exploded, so it never chooses.
        """
        return words.join(self.table.select("word", "value").hint("broadcast" if self.sent else "merge"), "word")

    def cut(self, words: DataFrame):
        """The vocabulary of the words in ``words``, a constant if at most ``cut_entries`` of them are listed.

        The distinct words of the texts, combined before they shuffle, pick the entries;
        no more than the bound is ever collected.
        """
        if self.inline:
            return self
        if self.sent:
            own = self.found_in(words.select("word")).distinct()
        else:
            own = self.table.join(words.select("word").distinct(), "word", "left_semi")
        rows = own.limit(self.cut_entries + 1).collect()
        size = sum(len(r["word"].encode()) + len(json.dumps({"value": r["value"]})) for r in rows)
        if len(rows) <= self.cut_entries and size <= MAX_INLINE_BYTES:
            return Vocabulary(entries={r["word"]: r["value"] for r in rows}, value_type=self.value_type)
        return self

    def constant(self) -> Column:
        """The vocabulary as one literal, parsed once when the plan is optimized."""
        buckets = [{} for _ in range(max(1, len(self.entries)))]
        for word, value in self.entries.items():
            buckets[zlib.crc32(word.encode()) % len(buckets)][word] = value
        schema = f"array<map<string,{self.value_type}>>"
        return F.from_json(F.lit(json.dumps(buckets)), schema)


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times in ``body``; lambdas share no work otherwise."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup(vocabulary: Column, word: Column) -> Column:
    """Value of ``word``, NULL when the vocabulary does not hold it."""
    bucket = (F.crc32(word.cast("binary")) % F.size(vocabulary)).cast("int")
    return F.try_element_at(F.get(vocabulary, bucket), word)


def text_key(*text: Column) -> Column:
    """Digest to match equal texts by. Missing texts match nothing and stay spread out."""
    nothing = F.concat(F.lit("none "), F.spark_partition_id().cast("string"))
    return F.coalesce(F.unhex(F.sha2(F.concat(*text), 256)), nothing.cast("binary"))


def by_text(df: DataFrame, key: str, digest: Column, columns, work, out: str) -> DataFrame:
    """Add column ``out``, worked out once per distinct text.

    ``work`` gets one row ``(key, *columns)`` per digest and returns it with ``out``.
    Copies of a text, however many, cost one piece of work; the results go back
    to their rows by digest, in a join that adaptive execution splits where one
    text has very many copies. A recomputed task finds the same digests.
    """
    df = df.withColumn(key, digest)
    distinct = df.select(key, *columns).dropDuplicates([key])
    done = work(distinct).select(key, F.col(out).alias(f"{key}__{out}"))
    return (df.join(done, key, "left").withColumn(out, F.col(f"{key}__{out}"))
            .drop(key, f"{key}__{out}"))


def distinct_words(df: DataFrame, parts: Column, word=None, keep=(), reads=()) -> DataFrame:
    """Rows ``(*keep, word)`` of the different elements of ``parts`` in each row of ``df``.

    ``word`` makes the word of an element, NULL for none, and may read the columns ``reads``. It
    runs after the elements are exploded, once for each different one, in compiled code.
    """
    part = "vocabulary__part"
    rows = df.select(*dict.fromkeys([*keep, *reads]), F.explode(F.array_distinct(parts)).alias(part))
    made = word(F.col(part)) if word else F.col(part)
    return rows.select(*keep, made.alias("word")).where(F.col("word").isNotNull())


def attach(df: DataFrame, vocabulary: Vocabulary, parts: Column, key: str, out: str, word=None, reads=()):
    """Return ``(df, column)`` where ``column`` can be given to ``lookup``.

    An inline vocabulary leaves ``df`` as it is. Otherwise ``df`` has one row per
    ``key`` (see ``by_text``): the distinct words of each row (see ``distinct_words``;
    ``word`` may read the columns ``reads``) meet the table, and ``df`` gains a small map
    of its own hits as ``out``.
    """
    if vocabulary.inline:
        return df, vocabulary.constant()
    asked = distinct_words(df, parts, word, [key], reads)
    hits = (vocabulary.found_in(asked)
            .groupBy(key).agg(F.collect_set(F.struct("word", "value")).alias("hits")))
    n = F.ceil(F.sqrt(F.size("hits"))).cast("int")
    own = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda b: F.map_from_entries(F.filter(
            "hits", lambda h: F.crc32(h["word"].cast("binary")) % n == b)))
    hits = hits.select(key, own.alias(out))
    empty = F.array(F.create_map().cast(f"map<string,{vocabulary.value_type}>"))
    df = df.join(hits, key, "left").withColumn(out, F.coalesce(F.col(out), empty))
    return df, F.col(out)
