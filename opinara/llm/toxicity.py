"""Toxicity by class-conditional Kneser-Ney models (op 8).

A bigram model of toxic and one of ordinary labelled documents score every text.
Each backs off from the bigrams of its class to those of both classes together, from
there to how many different words a word follows in the class, and from there to the
same over both classes, so that an expression too rare for either class alone is judged
nearly alike by both. Counts of 1, 2 and more have a discount each, estimated from the
counts themselves (Chen and Goodman, 1998). A text's mean
difference of log-likelihoods per word goes through a logistic curve fitted on labelled
rows that the models have not seen, with that of its most telling word by itself beside
it, as one insult hardly moves the mean of a long text.

The counts are those of all labelled training rows, with nothing left out, under 64-bit
hashes of words, and of bigrams 48 bits more under the range of their history. They stay in Spark, dealt by ranges of the hash of the history, as
tables of fixed-point values: what a word tells, what having it as history adds, and what a
known bigram adds to both. A chunk of texts asks each range once for all its words, with
the texts that hold them, and gets back sums by text. So neither the driver nor a
worker holds a model; of fixed size are a filter of known words and bigrams and the table of the
most frequent ones, which save requests and change no result.
"""

import hashlib
import pickle
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, discard, drop_others, free_of, materialise, names_for, possibly_in
from .words import FACTORS, blocks, free, mix, per_text, word_hashes

RANGE_BITS = 16  # high bits of a hash by which words are dealt out
FLUSH_WORDS = 1 << 20  # words of a task that are counted or asked for at once
DISCOUNT = 0.75  # of an order without anything that was seen once, or what follows from other counts
CALIBRATION_ROWS = 50_000  # about the most rows the logistic curve is fitted on, drawn by hash
COUNTED, FITTED = (0, 1), (3,)  # folds of labelled rows; fold 2 is held out from everything
UNIT = 1 << 14  # logarithms are whole multiples of one over this, so that sums do not depend on order
FILTER_BITS, SLICE_BITS = 27, 22  # a filter of 16 MB at any size, put together in slices
FREQUENT = 1 << 18  # about the most words, and bigrams, that every task holds: 4 MB of each
NONE = np.iinfo(np.int64).min

ROWS = "kind int, part int, src bigint, blob binary"
WORD, BIGRAM, TIMES, CELLS, BASE, FOLLOWS, REPLY = range(7)


def fold(id):
    return F.crc32(id.cast("string").cast("binary")) % 4


@dataclass
class Model:
    entries: DataFrame  # (kind, part, src, blob): sorted hashes and their values; a written table
    parts: int
    frequent: dict  # of words and of bigrams (hashes, values)
    known: np.ndarray  # bits of the filter
    unseen: int  # what a word tells that was not seen
    fit: np.ndarray | None = None  # logistic coefficients
    sent: Shared | None = None

    def shared(self):
        """What every task needs, all of fixed size; sent once."""
        if self.sent is None:
            self.sent = Shared(self.entries.sparkSession, (self.frequent, self.known, self.unseen))
        return self.sent


def discounts(*times):
    """The discounts of an order of which ``times[i]`` entries have the count ``i + 1``, each at most the count."""
    if not times[0]:
        return np.array([0, DISCOUNT, DISCOUNT, DISCOUNT])
    base = times[0] / (times[0] + 2 * times[1])
    own = [base]
    for i in (1, 2):
        own.append(float(np.clip(i + 1 - (i + 2) * base * times[i + 1] / times[i], base, i + 1)) if times[i] else base)
    return np.array([0, *own])


def kept(counts, taken):
    """What is left of counts after the discount for 0, 1, 2 and more."""
    return counts - taken[np.minimum(counts, 3)]


def part_of(hashes, parts):
    return (hashes >> np.uint64(64 - RANGE_BITS)).astype(np.int64) * parts >> RANGE_BITS


def pair_key(history, word):
    """48 bits, as bigrams are told apart within the range of their histories only."""
    return mix(history * FACTORS[0] + mix(word) * FACTORS[1]) >> np.uint64(16)


def cell_of(kind, hashes):
    return (hashes >> np.uint64((64 if kind == WORD else 48) - FILTER_BITS)).astype(np.int64)


def _small(values):
    """Whole numbers in the narrowest type that holds them."""
    if not len(values) or values.dtype.kind not in "iu" or values.dtype == np.uint64:
        return values
    low, high = values.min(), values.max()
    own = np.min_scalar_type(high) if low >= 0 else np.min_scalar_type(min(low, ~high))
    return values if own == np.uint64 else values.astype(own)


def _planes(values):
    """An array as its type and its bytes, all first ones before all second ones, which compress better."""
    return values.dtype.str, np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _pack(keys, *columns):
    """Arrays as one blob; the first is in order."""
    steps = np.diff(keys, prepend=keys.dtype.type(0))
    return zlib.compress(pickle.dumps([_planes(c) for c in (steps, *map(_small, columns))], protocol=5), 1)


def _open(blob):
    columns = []
    for kind, data in pickle.loads(zlib.decompress(blob)):
        kind = np.dtype(kind)
        planes = np.frombuffer(data, dtype=np.uint8).reshape(kind.itemsize, -1)
        columns.append(np.ascontiguousarray(planes.T).view(kind).ravel())
    steps, *columns = columns
    return [np.cumsum(steps, dtype=steps.dtype), *columns]


def _rows(rows):
    import pyarrow as pa

    kind, part, src, blob = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(src, pa.int64()), pa.array(blob, pa.binary())],
        names=["kind", "part", "src", "blob"])


def _dealt(kind, src, part, *columns):
    """A row for each part of columns that are in its order."""
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, np.int64)
    return [(kind, int(part[a]), src, _pack(*(c[a:b] for c in columns))) for a, b in zip(edges[:-1], edges[1:])]


def _firsts(*columns):
    """Where new values of sorted columns begin."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])


def _added(tables, keys):
    """Tables as one, in order of their first ``keys`` columns, equal ones with the sums of the other columns."""
    columns = [np.concatenate(c) for c in zip(*tables)]
    order = np.lexsort(columns[:keys][::-1])
    columns = [c[order] for c in columns]
    first = _firsts(*columns[:keys])
    return [c[first] for c in columns[:keys]] + [np.add.reduceat(c, first, dtype=np.int64) if len(first) else c.astype(np.int64) for c in columns[keys:]]


class Sum:
    """Adds up blobs as they come."""

    def __init__(self, keys):
        self.keys, self.whole, self.waiting, self.held = keys, None, [], 0

    def add(self, blob):
        self.waiting.append(_open(blob))
        self.held += len(self.waiting[-1][0])
        if self.held > max(FLUSH_WORDS, 0 if self.whole is None else len(self.whole[0])):
            self.all()

    def all(self):
        if self.waiting:
            self.whole = _added([*([self.whole] if self.whole else []), *self.waiting], self.keys)
            self.waiting, self.held = [], 0
        return self.whole


def _each(batches):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("kind", "part", "src", "blob")))


def _groups(batches, *by):
    """Rows sorted by the columns numbered ``by``, group by group: ``(values, rows)``."""
    held, rows = None, _each(batches)
    row = next(rows, None)

    def own():
        nonlocal row
        while row is not None and tuple(row[i] for i in by) == held:
            yield row
            row = next(rows, None)

    while row is not None:
        held = tuple(row[i] for i in by)
        yield held, own()


# --- counting ---

def _texts(offsets, data):
    """Word hashes of a block, the text of each, and the number of words of each text."""
    hashes, starts, _ = word_hashes(offsets, data)
    n = np.diff(per_text(offsets, starts))
    return hashes, np.repeat(np.arange(len(n)), n), n


def _count(parts):
    """Words and bigrams of a partition; a bigram once a text, as what one text repeats is no evidence of its class."""
    def counted(words, pairs):
        words = _added([(w, np.ones(len(w), dtype=np.int64)) for w in words], 1)
        pairs = _added(pairs, 2)
        return _rows(_dealt(WORD, -1, part_of(words[0], parts), *words) + _dealt(BIGRAM, -1, part_of(pairs[0], parts), *pairs))

    def count(batches):
        drop_others()
        for batch in batches:
            toxic = batch.column("toxic").to_numpy() > 0
            words, pairs, held = [], [], 0
            for first, offsets, data in blocks(batch.column("text")):
                hashes, text, _ = _texts(offsets, data)
                same = text[1:] == text[:-1]
                h, w, t = hashes[:-1][same], hashes[1:][same], text[1:][same]
                order = np.lexsort((pair_key(h, w), t))
                h, w, t = h[order], w[order], t[order]
                once = _firsts(h, w, t)
                c = toxic[t[once] + first]
                words.append(hashes)
                pairs.append((h[once], w[once], ~c, c))
                held += len(hashes)
                if held >= FLUSH_WORDS:
                    yield counted(words, pairs)
                    words, pairs, held = [], [], 0
            if words:
                yield counted(words, pairs)
    return count


def _histogram(*counts):
    """How many entries have the count 0 to 4, and how many a larger one."""
    return sum(np.bincount(np.minimum(n, 5), minlength=6) for n in counts)


def _sum_counts(parts):
    """Add up words and bigrams; of the bigrams also how many different words each word follows, and how often counts occur."""
    def work(batches):
        for (kind, part), rows in _groups(batches, 0, 1):
            total = Sum(1 if kind == WORD else 2)
            for row in rows:
                total.add(row[3])
            columns = total.all()
            yield _rows([(kind, part, -1, _pack(*columns))])
            if kind == BIGRAM:
                _, w, plain, toxic = columns
                follows = _added([(w, plain > 0, toxic > 0)], 1)
                yield _rows([(TIMES, part, -1, _pack(_histogram(plain, toxic)))] + _dealt(FOLLOWS, part, part_of(follows[0], parts), *follows))
    return work


def _sum_follows(batches):
    """Of each word: after how many words it stands in either class, and its count."""
    for (part,), rows in _groups(batches, 1):
        total = Sum(1)
        for kind, _, _, blob in rows:
            if kind == WORD:
                w, n = _open(blob)
                nothing = np.zeros(len(w), dtype=np.int8)
                blob = _pack(w, nothing, nothing, n)
            else:
                blob = _pack(*(own := _open(blob)), np.zeros(len(own[0]), dtype=np.int8))
            total.add(blob)
        columns = total.all()
        told = [x for f in columns[1:3] for x in (*_histogram(f), f.sum())]
        yield _rows([(WORD, part, -1, _pack(*columns)), (TIMES, part, -1, _pack(np.array([*told, len(columns[0])])))])


def _reply(batches):
    """Send what was found of words back to the ranges whose bigrams end in them."""
    for (part,), rows in _groups(batches, 1):
        for kind, _, src, blob in rows:
            if kind == WORD:
                words, plain, toxic, _ = _open(blob)
            else:
                asked = _open(blob)[0]
                at = np.searchsorted(words, asked)
                yield _rows([(REPLY, src, -1, _pack(asked, plain[at], toxic[at]))])


@dataclass
class Lower:
    """Probability of a word after backoff, by the number of words it follows."""

    taken: np.ndarray
    total: tuple  # by class
    free: tuple  # what the discounts leave for the shared distribution
    words: int

    @classmethod
    def of(cls, told):
        """From rows of ``(histogram and sum of either class, words)``."""
        told = np.sum(told, axis=0, dtype=np.int64) if len(told) else np.zeros(15, dtype=np.int64)
        times, total = told[[*range(0, 6), *range(7, 13)]].reshape(2, 6), (told[6], told[13])
        taken = discounts(*times.sum(axis=0)[1:5])
        free = tuple(taken[1] * t[1] + taken[2] * t[2] + taken[3] * t[3:].sum() for t in times)
        return cls(taken, total, free, int(told[14]) + 1)

    def probability(self, *follows):
        shared = (follows[0].astype(np.int64) + follows[1] + 0.5) / (sum(self.total) + 0.5 * self.words)
        return [(kept(f, self.taken) + free * shared) / n if n else shared for f, free, n in zip(follows, self.free, self.total)]

    def telling(self, *follows):
        plain, toxic = self.probability(*follows)
        return np.log(toxic / plain)


def _whole(logs):
    return np.rint(logs * UNIT).astype(np.int64)


def _most(n, most, keys, *values):
    """The ``most`` entries with the greatest counts ``n``, in order of their keys."""
    top = np.sort(np.argsort(-n, kind="stable")[:most])
    return [c[top] for c in (keys, *values)]


def _values(most, taken, lower):
    """The values of the words and bigrams of a range, and apart those of its ``most`` frequent ones."""
    def work(batches):
        for (part,), rows in _groups(batches, 1):
            replies, pairs = Sum(1), None
            for kind, _, _, blob in rows:
                if kind == WORD:
                    words, *follows, times = _open(blob)
                elif kind == BIGRAM:
                    pairs = _open(blob)
                else:
                    replies.add(blob)
            tells, adds = _whole(lower.telling(*follows)), np.zeros(len(words), dtype=np.int64)
            cells = [cell_of(WORD, words)]
            if pairs:
                h, w, *seen = pairs
                first = _firsts(h)
                own = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(h)]))
                seen = [n.astype(np.int64) for n in seen]
                left, weight = [], []  # by class, then of both together
                for n in (*seen, seen[0] + seen[1]):
                    total = np.add.reduceat(n, first)
                    rest = kept(n, taken)
                    weight.append(np.where(total > 0, (total - np.add.reduceat(rest, first)) / np.maximum(total, 1), 1))
                    left.append(rest / np.maximum(total, 1)[own])
                after, *ends = replies.all()
                at = np.searchsorted(after, w)
                ends = [n[at] for n in ends]
                logs = [np.log(left[c] + weight[c][own] * (left[2] + weight[2][own] * p)) for c, p in enumerate(lower.probability(*ends))]
                history = np.log(weight[1] / weight[0])
                known = _whole(logs[1] - logs[0]) - _whole(history)[own] - _whole(lower.telling(*ends))
                adds[np.searchsorted(words, h[first])] = _whole(history)
                keys = pair_key(h, w)
                order = np.argsort(keys, kind="stable")
                keys, known = keys[order], known[order]
                n = (seen[0] + seen[1])[order]
                nothing = np.zeros(len(keys), dtype=np.int8)
                yield _rows([(BIGRAM, part, -1, _pack(keys, known, nothing)),
                             (TIMES, part, BIGRAM, _pack(*_most(n, most, keys, known, nothing)))])
                cells.append(cell_of(BIGRAM, keys))
            yield _rows([(WORD, part, -1, _pack(words, tells, adds)),
                         (TIMES, part, WORD, _pack(*_most(times, most, words, tells, adds)))])
            cells = np.unique(np.concatenate(cells))
            yield _rows(_dealt(CELLS, -1, cells >> SLICE_BITS, cells & ((1 << SLICE_BITS) - 1)))
    return work


def _fill(batches):
    """The bits of a slice of the filter."""
    for (part,), rows in _groups(batches, 1):
        bits = np.zeros(1 << SLICE_BITS, dtype=bool)
        for row in rows:
            bits[_open(row[3])[0]] = True
        yield _rows([(CELLS, part, -1, zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))])


def _within(rows, parts, work, *by):
    """``work`` over rows dealt by ``part`` and, if ``by`` begins so, ``kind``; ``by`` is the order in a task."""
    dealt = ["kind", "part"] if by[0] == "kind" else ["part"]
    return rows.repartition(parts, *dealt).sortWithinPartitions(*by).mapInArrow(work, ROWS)


def count_model(rows: DataFrame, frequent=FREQUENT) -> Model:
    """The models of ``(text, toxic)`` rows, with every word and bigram; about ``frequent`` of each go to all tasks."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    raw = rows.select("text", "toxic").mapInArrow(_count(parts), ROWS)
    counts = materialise(_within(raw, parts, _sum_counts(parts), "kind", "part"), "counts")

    def told(table):  # one small row a part
        return [_open(r["blob"])[0] for r in table.where(F.col("kind") == TIMES).select("blob").collect()]

    found = told(counts)
    taken = discounts(*(np.sum(found, axis=0)[1:5] if found else [0] * 4))
    of = F.col("kind")
    words = materialise(_within(counts.where(of.isin(WORD, FOLLOWS)), parts, _sum_follows, "part"), "words")
    lower = Lower.of(told(words))
    known_words = words.where(of == WORD)
    replies = _within(known_words.unionByName(counts.where(of == FOLLOWS)), parts, _reply, "part", "kind")
    both = known_words.unionByName(counts.where(of == BIGRAM)).unionByName(replies)
    entries = materialise(_within(both, parts, _values(max(1, frequent // parts), taken, lower), "part", "kind"), "entries")
    discard(counts, words)
    nothing = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    most = {WORD: [nothing], BIGRAM: [nothing]}
    for row in entries.where(of == TIMES).collect():  # ``frequent`` of either kind at most, or one a part
        most[row["src"]].append(_open(row["blob"]))
    for kind, tables in most.items():
        columns = [np.concatenate(c) for c in zip(*tables)]
        order = np.argsort(columns[0], kind="stable")
        most[kind] = [c[order] for c in columns]
    known = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    size = 1 << (SLICE_BITS - 3)
    for row in _within(entries.where(of == CELLS), 1 << (FILTER_BITS - SLICE_BITS), _fill, "part").toLocalIterator():
        known[row["part"] * size:(row["part"] + 1) * size] = np.frombuffer(zlib.decompress(row["blob"]), dtype=np.uint8)
    none = np.zeros(1, dtype=np.int64)
    return Model(entries.where(of.isin(WORD, BIGRAM)), parts, most, known, int(_whole(lower.telling(none, none))[0]))


# --- scoring ---

def text_key(text):
    """What texts are told apart by."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


class Chunk:
    """Texts that ask together; what the frequent and the unknown words say is added at once."""

    def __init__(self, keys, n, model):
        self.keys, self.n = keys, n
        self.frequent, self.known, self.unseen = model
        self.sums, self.top, self.asked = np.zeros(len(n), dtype=np.int64), np.full(len(n), NONE), 0
        told = hashlib.blake2b(b"".join(keys) + pickle.dumps((TaskContext.get().partitionId(), self.n.tobytes())), digest_size=8)
        self.id = int.from_bytes(told.digest(), "little", signed=True)

    def ask(self, kind, hashes, routes, text, last, parts):
        """Rows that ask for what is left."""
        order = np.argsort(hashes, kind="stable")  # the texts of a hash stay in order
        hashes, routes, text, last = hashes[order], routes[order], text[order], last[order]
        first = _firsts(hashes, text)
        if not len(first):
            return []
        times, ends = np.diff(np.r_[first, len(hashes)]), np.add.reduceat(last, first, dtype=np.int64)
        hashes, routes, text = hashes[first], routes[first], text[first]
        own, tells, adds = self.frequent[kind]
        at = np.minimum(np.searchsorted(own, hashes), max(len(own) - 1, 0))
        here = own[at] == hashes if len(own) else np.zeros(len(hashes), dtype=bool)
        cell = cell_of(kind, hashes)
        open_ = ~here & ((self.known[cell >> 3] >> (cell & 7).astype(np.uint8) & 1) > 0)
        new = ~here & ~open_
        self.say(kind, text[here], tells[at[here]], adds[at[here]], times[here], ends[here])
        if kind == WORD:
            self.say(kind, text[new], np.full(new.sum(), self.unseen), np.zeros(new.sum(), dtype=np.int64), times[new], ends[new])
        self.asked += int(open_.sum())
        hashes, part, text = hashes[open_], part_of(routes[open_], parts), text[open_]
        code = times[open_] << 1 | ends[open_]
        order = np.argsort(part, kind="stable")
        hashes, part, text, code = hashes[order], part[order], text[order], code[order]
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, np.int64)
        rows = []
        for a, b in zip(edges[:-1], edges[1:]):
            first = _firsts(hashes[a:b])
            size = np.diff(np.r_[first, b - a])
            rows.append((kind, int(part[a]), self.id, _pack(hashes[a:b][first], size, text[a:b], code[a:b])))
        return rows

    def say(self, kind, text, tells, adds, times, ends):
        self.sums += np.bincount(text, tells * times + adds * (times - ends), len(self.n)).astype(np.int64)
        if kind == WORD:
            np.maximum.at(self.top, text, tells)


def _ask(parts, shared, most):
    """Chunks of texts as rows: one with what is known of them and one for each range that is asked."""
    def asked(held, model):
        keys, hashes, text, n = [], [], [], []
        for own_keys, own_hashes, own_text, own_n in held:
            text.append(own_text + len(keys))
            keys += own_keys
            hashes.append(own_hashes)
            n.append(own_n)
        hashes, text, n = map(np.concatenate, (hashes, text, n))
        chunk = Chunk(keys, n, model)
        same = text[1:] == text[:-1]
        rows = chunk.ask(WORD, hashes, hashes, text, np.r_[~same, True][:len(text)], parts)
        h, w = hashes[:-1][same], hashes[1:][same]
        rows += chunk.ask(BIGRAM, pair_key(h, w), h, text[1:][same], np.zeros(len(h), dtype=bool), parts)
        base = zlib.compress(pickle.dumps((keys, n, chunk.sums, chunk.top, chunk.asked), protocol=5), 1)
        return _rows([*rows, (BASE, chunk.id % parts, chunk.id, base)])

    def ask(batches):
        model = shared.value
        for batch in batches:
            keys, held, size = batch.column("key").to_pylist(), [], 0
            for first, offsets, data in blocks(batch.column("text")):
                hashes, text, n = _texts(offsets, data)
                held.append((keys[first:first + len(n)], hashes, text, n))
                size += len(hashes)
                if size >= most:
                    yield asked(held, model)
                    held, size = [], 0
                    free()
            if held:
                yield asked(held, model)
    return ask


def _answer(unseen):
    """Sums by text of what a chunk asked of a range."""
    def answer(batches):
        for (kind, part), rows in _groups(batches, 0, 1):
            table = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            for _, _, src, blob in rows:
                if kind == BASE:
                    yield _rows([(kind, part, src, blob)])
                    continue
                if src is None:
                    table = _open(blob)
                    continue
                own, tells, adds = table
                hashes, size, text, code = _open(blob)
                at = np.minimum(np.searchsorted(own, hashes), max(len(own) - 1, 0))
                found = own[at] == hashes if len(own) else np.zeros(len(hashes), dtype=bool)
                tells = np.where(found, tells[at] if len(own) else 0, unseen if kind == WORD else 0).astype(np.int64).repeat(size)
                adds = np.where(found, adds[at] if len(own) else 0, 0).astype(np.int64).repeat(size)
                times, ends = code.astype(np.int64) >> 1, code.astype(np.int64) & 1
                order = np.argsort(text, kind="stable")
                text, value, tells = text[order], (tells * times + adds * (times - ends))[order], tells[order]
                first = _firsts(text)
                top = np.maximum.reduceat(tells, first) if kind == WORD else np.full(len(first), NONE)
                yield _rows([(kind, part, src, _pack(text[first].astype(np.int64), np.add.reduceat(value, first), top, np.array([len(text)])))])
    return answer


def _measured(batches):
    """Of each text its mean difference, that of its most telling word, and whether it has words."""
    import pyarrow as pa

    for (src,), rows in _groups(batches, 2):
        base, asked = None, 0
        for kind, _, _, blob in rows:
            if kind == BASE:
                keys, n, sums, tops, left = pickle.loads(zlib.decompress(blob))
                base, asked = True, asked + left
                continue
            text, value, top, answered = _open(blob)
            sums[text] += value
            np.maximum.at(tops, text, top.astype(np.int64))
            asked -= int(answered[0])
        if asked:
            raise RuntimeError("texts came in another order when read again: write them first")
        mean = sums / UNIT / np.maximum(n, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(mean), pa.array(np.where(n > 0, tops / UNIT, 0.0)), pa.array((n > 0).astype(np.float64))],
            names=["key", "mean", "top", "words"])


def measures(texts: DataFrame, model: Model, text="text", chunk=FLUSH_WORDS) -> DataFrame:
    """One row ``(key, mean, top, words)`` for each different text, by ``text_key``; some ``chunk`` words ask together."""
    column = F.col(text).cast("string")
    asks = texts.select(text_key(column).alias("key"), column.alias("text")).mapInArrow(_ask(model.parts, model.shared(), chunk), ROWS)
    entries = model.entries.withColumn("src", F.lit(None).cast("bigint"))
    # The table of a range comes before those that ask it: a missing src sorts first.
    answers = _within(entries.unionByName(asks), model.parts, _answer(model.unseen), "kind", "part", "src")
    answers = answers.withColumn("kind", F.when(F.col("kind") == BASE, F.lit(BASE)).otherwise(F.lit(BASE + 1)))
    answers = answers.repartition(model.parts, "src").sortWithinPartitions("src", "kind")
    rows = answers.mapInArrow(_measured, "key binary, mean double, top double, words double")
    # Copies of a text have equal sums.
    return rows.groupBy("key").agg(*[F.max(c).alias(c) for c in ("mean", "top", "words")])


def logistic(x, y, rounds=50, ridge=1e-3):
    """Coefficients of a logistic curve over the columns of ``x`` and a constant, by Newton's method."""
    scale = x.std(axis=0)
    scale[scale < 1e-9] = 1
    z = np.c_[x / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + ridge * w
        curve = (z * (p * (1 - p))[:, None]).T @ z + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.r_[w[:-1] / scale, w[-1]]


def training_rows(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str) -> DataFrame:
    """Labelled rows ``(id, text, toxic, fold)`` outside fold 2; only texts whose id may be labelled shuffle."""
    known = (labels.where(F.col(label).isNotNull()).select(F.col(id).cast("string").alias("id"), F.col(label).alias("toxic"))
             .where("id IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic")))
    known = known.where(fold(F.col("id")) != 2)
    rows = docs.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text")).where(fold(F.col("id")) != 2)
    rows = possibly_in(rows, F.col("id"), known, "id")
    rows = rows.join(known.hint("merge"), "id")
    return rows.select("id", "text", (F.col("toxic") > 0).cast("int").alias("toxic"), fold(F.col("id")).alias("fold"))


def train(docs: DataFrame, labels: DataFrame, id="doc_id", text="text", label="toxic", rows=CALIBRATION_ROWS) -> Model:
    """Count the models on folds 0 and 1 of the labelled rows and fit the curve on a sample of about ``rows`` of fold 3, if it has more.

    Fold 2, by ``crc32`` of the id modulo 4, plays no part. A row labelled twice
    counts as toxic if any label says so.
    """
    known = materialise(training_rows(docs, labels, id, text, label), "labelled")
    model = count_model(known.where(F.col("fold").isin(*COUNTED)))
    sample = known.where(F.col("fold").isin(*FITTED))
    share = rows / max(rows, sample.count())
    # By hash, in all tasks alike; only the measures reach the driver.
    sample = sample.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("text", "toxic")
    measured = materialise(measures(sample, model), "measured")
    found = sample.select(text_key(F.col("text")).alias("key"), "toxic").join(measured, "key")
    found = found.select("mean", "top", "words", F.col("toxic").cast("double")).toPandas().to_numpy()
    discard(known, measured)
    found = found[np.lexsort(found.T)]
    y = found[:, 3] if len(found) else np.zeros(0)
    if 0 < y.sum() < len(y):
        model.fit = logistic(found[:, :3], y)
    else:  # one class only, or nothing: its share, whatever the text
        share = (y.sum() + 0.5) / (len(y) + 1)
        model.fit = np.r_[0.0, 0.0, 0.0, np.log(share / (1 - share))]
    return model


def rating(model: Model):
    """The score of a row of measures."""
    *slopes, constant = (F.lit(float(x)) for x in model.fit)
    line = constant
    for slope, column in zip(slopes, ("mean", "top", "words")):
        line = line + slope * F.col(column)
    return 1 / (1 + F.exp(-F.least(F.greatest(line, F.lit(-30.0)), F.lit(30.0))))


def score(df: DataFrame, model: Model, text="text", least=0.3) -> DataFrame:
    """Add ``score`` (0 to 1, the likelier toxic the higher) and ``predicted`` (1 from ``least`` on).

    Uses nothing but the whole text; scores come to their rows by a digest of the
    text, so a text that is not used later does not shuffle. A null or empty text has no
    words and gets what the fitted curve says of that; repeated rows score alike; an
    empty table gives no rows. Other columns stay; those named like the new ones
    become ``<name>_in``.
    """
    if text.lower() in ("score", "predicted"):
        raise ValueError(f"the text column may not be called {text}")
    df = free_of(df, "score", "predicted")
    key, = names_for(df, "text_key")
    rated = measures(df, model, text).select(F.col("key").alias(key), rating(model).alias("score"))
    # The planner takes what comes from Python for as small as its input; a merge join is split where a text has many copies.
    df = df.withColumn(key, text_key(F.col(text))).join(rated.hint("merge"), key, "left").drop(key)
    return df.withColumn("predicted", (F.col("score") >= least).cast("int"))


def drop_toxic(df: DataFrame, model: Model, text="text", least=0.3) -> DataFrame:
    """The rows of ``df`` that score below ``least``, with their columns as they are.

    The digests of the texts to go are written first, so that the planner knows
    their size: up to its bound they are broadcast, beyond it the rows shuffle.
    """
    key, = names_for(df, "text_key")
    gone = measures(df, model, text).where(rating(model) >= least).select(F.col("key").alias(key))
    gone = materialise(gone, "toxic")
    return df.withColumn(key, text_key(F.col(text))).join(gone, key, "left_anti").select(df.columns)
