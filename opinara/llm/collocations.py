"""Phrases whose words keep together, counted by prefix-free parsing (op 13).

Each text becomes one stream of words with a mark between pieces, and two marks at its
end. Where a window of two tokens hashes to 0 modulo ``EVERY`` a chunk ends with that
window and the next one begins with it, so equal passages are cut alike
wherever they stand. The distinct chunks and how often each was parsed are the
dictionary; all counting happens there, weighted, once a chunk.

Chunks overlap by two tokens. Phrases of up to three words therefore lie whole in the
chunk that holds their first word ahead of its last two tokens, and are counted
only there: each occurrence once.

Words are counted first, then pairs of words that may be frequent, then triples of
pairs that may be: no phrase is more frequent than its parts. What may be
frequent is asked of a filter of bounded size that has no false misses, so counts
stay exact at any size; a full filter only lets more through.
"""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, materialise

LONGEST, LEAST, SHARE, SHOWN, SCALE = 3, 10, 50, 2000, 1_000_000
OVERLAP = LONGEST - 1
EVERY, LONGEST_CHUNK = 20, 4096
CELLS, BITMAP = 1 << 26, 32768  # a filter of 8 MB
FACTORS = 0x1F123BB5, 0x159A55E5, 0x1B873593  # of the language, a word and the next one; products stay below 2^61
PARSED, CHUNKS_HELD = 4 << 20, 24 << 20  # bytes parsed at once, and bytes of chunks held before they are sent on
COUNTED = 8 << 20  # bytes of chunks counted at once: fewer than 2^21 different words
SPACE, MARK = 32, 46
# Of every byte: marks for what ends a piece, a space for a tab, small letters for A-Z.
FOLD = bytes(MARK if b in b".,;:!?\n\x0b\x0c\r" else SPACE if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
END = b" . . "


def _tokens(data, cuts):
    """Words and marks of bytes: where they begin and end. Words end at ``cuts`` too."""
    word = (data != SPACE) & (data != MARK)
    mark = data == MARK
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[cuts] = True
    starts = mark | (word & (~np.r_[False, word[:-1]] | edge[:-1]))
    ends = mark | (word & (~np.r_[word[1:], False] | edge[1:]))
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _chunks(data, texts):
    """Chunks of folded texts that stand in ``data`` one after the other, each with two marks behind it.

    ``texts`` are the places where they begin. A window ends a chunk by its own bytes alone.
    """
    starts, ends = _tokens(data, texts)
    first = np.searchsorted(starts, texts)
    last = np.r_[first[1:], len(starts)] - OVERLAP  # the two marks
    look = (data[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + data[(starts + ends) // 2].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            + data[ends - 1].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    window = look[:-1] * np.uint64(0xE7037ED1A0B428DB) + (look[1:] ^ (look[1:] >> np.uint64(29)))
    cut = np.zeros(len(starts), dtype=bool)
    cut[:-1] = ((window ^ (window >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(EVERY) == 0
    cut[last + 1] = False
    cut[first] = True
    cut[last] = True
    places = np.flatnonzero(cut)
    far = np.flatnonzero(np.diff(places) > LONGEST_CHUNK)  # no window ends a chunk for so long
    if len(far):
        places = np.sort(np.concatenate([places, *[np.arange(places[i] + LONGEST_CHUNK, places[i + 1], LONGEST_CHUNK) for i in far]]))
    begins = places[~np.isin(places, last)]
    finish = places[np.searchsorted(places, begins, side="right")] + OVERLAP - 1
    return starts[begins], ends[finish]


def _parse(batches):
    """Texts to ``(lang, chunk, n)``, added up in pieces."""
    import pyarrow as pa

    texts, length, held, size = {}, 0, {}, 0

    def settle():
        nonlocal size
        for lang, own in texts.items():
            data = (END.join(own) + END).translate(FOLD)
            places = np.cumsum([0, *(len(t) + len(END) for t in own[:-1])])
            counts = held.setdefault(lang, Counter())
            before = len(counts)
            found = [data[a:b] for a, b in zip(*(x.tolist() for x in _chunks(np.frombuffer(data, dtype=np.uint8), places)))]
            counts.update(found)
            size += len(data) * (len(counts) - before) // max(1, len(found))

    def rows():
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(counts, pa.binary()), pa.array(counts.values(), pa.int64())], names=["lang", "chunk", "n"])

    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang")):
            text = text.as_py()
            if text:
                texts.setdefault(lang.as_py(), []).append(text)
                length += len(text)
                if length > PARSED:
                    settle()
                    texts, length = {}, 0
                    if size > CHUNKS_HELD:
                        yield from rows()
                        held, size = {}, 0
    settle()
    yield from rows()


def dictionary(df: DataFrame, text="text", lang="lang") -> DataFrame:
    """Distinct chunks of each language and how often each was parsed: ``(lang, chunk, n)``."""
    texts = df.select(F.col(text).cast("binary").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    parsed = texts.mapInArrow(_parse, "lang string, chunk binary, n bigint")
    return parsed.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def _cell(lang, word, after=None):
    """The filter's cell of a word, or of two in a row, as a column or as whole numbers, from their checksums."""
    total = lang * FACTORS[0] + word * FACTORS[1]
    return (total if after is None else total + after * FACTORS[2]) % CELLS


def frequent_filter(counts: DataFrame, size: int) -> Shared:
    """The filter of the phrases of ``counts``, of ``size`` words: at most ``CELLS`` bits, whatever the number of rows."""
    def checksum(text):
        return F.crc32(text.cast("binary"))

    cell = _cell(checksum(F.col("lang")), *[checksum(w) for w in (F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1))[:size]])
    parts = counts.select(F.floor(cell / BITMAP).alias("part"), (cell % BITMAP).alias("bit"))
    parts = parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = np.zeros(CELLS // 8, dtype=np.uint8)
    for row in parts.collect():
        bits[row["part"] * BITMAP // 8:(row["part"] + 1) * BITMAP // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return Shared(counts.sparkSession, bits)


def _has(bits, cells):
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1


def _sums(codes, weights):
    """Distinct codes and their weights, added up as whole numbers."""
    order = np.argsort(codes)
    codes = codes[order]
    edges = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[edges], np.add.reduceat(weights[order], edges)


def _encoded(chunks):
    """Tokens of an Arrow array of chunks as numbers: ``(numbers, different tokens, tokens of each chunk)``."""
    import pyarrow as pa

    _, places, values = chunks.buffers()
    offsets = np.frombuffer(places, dtype=np.int32)[chunks.offset:chunks.offset + len(chunks) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    starts, _ = _tokens(data, offsets)
    kept = data != SPACE  # without spaces the tokens stand one behind the other
    begins = (np.cumsum(kept) - kept)[starts]
    packed = data[kept]
    tokens = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.r_[begins, len(packed)].astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())])
    coded = tokens.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.diff(np.r_[np.searchsorted(starts, offsets[:-1]), len(starts)])


def _counter(size, frequent):
    """Task function: weighted counts of the phrases of ``size`` words whose parts may be frequent."""
    def count_lang(lang, chunks, freqs, filters):
        """Phrases as columns of word numbers, the words, and the sums."""
        numbers, words, lengths = _encoded(chunks)
        m, weights = len(words), np.repeat(freqs, lengths)
        first = np.ones(len(numbers), dtype=bool)  # places that this chunk counts, not the next one
        ends = np.cumsum(lengths)
        for back in range(1, OVERLAP + 1):
            first[ends - back] = False
        spelt = words.to_pylist()
        word = np.array([w != b"." for w in spelt])
        if size > 1:
            own = zlib.crc32(lang.encode())
            sums = np.fromiter(map(zlib.crc32, spelt), np.int64, m)
            word &= _has(filters[0], _cell(own, sums))
        good = word[numbers]
        at = np.flatnonzero(first & good)
        for ahead in range(1, size):
            at = at[good[at + ahead]]
        for ahead in range(1, size - 1):
            for a in (0, 1):
                at = at[_has(filters[1], _cell(own, sums[numbers[at + a]], sums[numbers[at + a + 1]]))]
        if not len(at):
            return [], words, at
        codes = numbers[at]
        for ahead in range(1, size):
            codes = codes * m + numbers[at + ahead]
        found, totals = _sums(codes, weights[at])
        columns = []
        for _ in range(size):
            columns.append(found % m)
            found = found // m
        return columns[::-1], words, totals

    def count(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        filters = [f.value for f in frequent]
        held, length = [], 0

        def rows():
            table = pa.Table.from_batches(held)
            for lang in pc.unique(table["lang"]).to_pylist():
                own = table.filter(pc.equal(table["lang"], lang)).combine_chunks()
                columns, words, totals = count_lang(lang, own["chunk"].combine_chunks(), own["n"].to_numpy(), filters)
                if columns:
                    taken = [words.take(pa.array(c)) for c in columns]
                    phrases = pc.binary_join_element_wise(*taken, pa.scalar(b" ", pa.binary())) if size > 1 else taken[0]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(totals), pa.string()), phrases.cast(pa.string()), pa.array(totals)], names=["lang", "phrase", "n"])

        for batch in batches:
            while batch.num_rows:
                ends = np.frombuffer(batch.column("chunk").buffers()[1], dtype=np.int32)[batch.column("chunk").offset:][:batch.num_rows + 1].astype(np.int64)
                k = max(1 if not held else 0, int(np.searchsorted(ends, ends[0] + COUNTED - length, side="right")) - 1)
                if k:
                    held.append(batch.slice(0, k))
                    length += int(ends[k] - ends[0])
                    batch = batch.slice(k)
                if batch.num_rows or length >= COUNTED:
                    yield from rows()
                    held, length = [], 0
        if held:
            yield from rows()
    return count


def phrase_counts(chunks: DataFrame, size: int, frequent=()) -> DataFrame:
    """``(lang, phrase, n)`` of all phrases of ``size`` words, but for those of which a part is rare by ``frequent``."""
    parts = chunks.mapInArrow(_counter(size, list(frequent)), "lang string, phrase string, n bigint")
    return parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _scored(counts: DataFrame) -> DataFrame:
    """Candidates of all lengths with their lowest-scoring cut: ``lang, phrase, a, l, r, score``."""
    phrases = counts.where(F.col("size") > 1)
    words = F.split("phrase", " ", -1)
    cuts = F.flatten(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit(0).alias("side"), F.array_join(F.slice("words", F.lit(1), k), " ").alias("part")),
        F.struct(k.alias("k"), F.lit(1).alias("side"), F.array_join(F.slice("words", k + 1, F.col("size") - k), " ").alias("part")))))
    parts = phrases.withColumn("words", words).select("lang", "phrase", F.col("n").alias("a"), F.inline(cuts))
    parts = parts.join(counts.where(F.col("size") < LONGEST).select("lang", F.col("phrase").alias("part"), "n").hint("merge"), ["lang", "part"])
    sides = [F.max(F.when(F.col("side") == s, F.col("n"))).alias(name) for s, name in ((0, "l"), (1, "r"))]
    cut = parts.groupBy("lang", "phrase", "a", "k").agg(*sides)
    whole = "decimal(38,0)"
    score = F.expr(f"(cast(cast(a as decimal(19,0)) * cast(a as decimal(19,0)) as {whole}) * {SCALE}BD) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    cut = cut.withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cut.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(df: DataFrame, text="text", lang="lang", shown=SHOWN) -> DataFrame:
    """The phrases of each language that keep together best: ``lang, rank, phrase, a, l, r, n, score``.

    Texts, with A-Z in small letters, fall into pieces at ``. , ; : ! ?`` and the line
    breaks 0x0A-0x0D, and these into words at spaces and tabs. ``n`` counts the words of
    a language, ``a`` the occurrences of a phrase of two or three words within pieces,
    overlapping ones too. With the phrase cut in two, ``l`` and ``r`` count its
    parts, and the score is ``floor(1e6 a a / (l r))``, the lowest over the cuts. Phrases
    need ten occurrences; one that a longer such phrase holds in half of them or
    more is left out. Ranks go by falling score, falling ``a``, then phrase in byte order.

    Null texts are empty; a null language is ``und``. Texts are read whole, repeated rows
    count each; ids and other columns play no part, whatever their names. A language
    without such phrases, and an empty table, give no rows.
    """
    chunks = materialise(dictionary(df, text, lang), "chunks")
    words = materialise(phrase_counts(chunks, 1), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    counts, frequent = [words.where(F.col("n") >= LEAST).withColumn("size", F.lit(1))], []
    for size in range(2, LONGEST + 1):
        frequent.append(frequent_filter(counts[-1], size - 1))
        found = phrase_counts(chunks, size, frequent).where(F.col("n") >= LEAST)
        counts.append(materialise(found.withColumn("size", F.lit(size)), f"phrases-{size}"))
    every = counts[0].unionByName(counts[1]).unionByName(counts[2])
    scored = _scored(every)

    inner = F.array(F.substring_index("phrase", " ", 2), F.expr("substring(phrase, instr(phrase, ' ') + 1)"))
    longer = counts[2].select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.lit(100) * F.col("longer") < F.lit(SHARE) * F.col("a"), F.lit(True)))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A share of a language's phrases first: no task sorts all of a hot language.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(32))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= shown).drop("rank")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= shown)
    return best.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
