"""Removal of repeated byte strings with a suffix sort (op 7).

Every string of ``LENGTH`` bytes has an anchor, the place of its least hash of
``GRAM`` bytes; equal strings have equal anchors at equal places. Strings that
follow each other share an anchor, so a text is a row of runs, one per anchor.
Runs meet by anchor. A run that a smaller document has in full is covered at once.

Most runs that meet agree in little more than the anchor. A string holds ``LEFT``
bytes before its anchor or ``RIGHT`` bytes behind it, so a run has two sides: its
strings of the first kind, and the others. A side is open if different runs of
different documents have its anchor with those bytes. Open sides meet by anchor and
bytes, and the suffixes that begin at their strings are sorted, eight bytes at a
time; those that share their hash of ``LENGTH`` bytes with no other are left out.
The smallest document of each group of equals decides.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, forget, free_of, materialise, names_for
from .lines import _columns_of, _pack, _unpack, in_filter, key_filter
from .words import Hashes, blocks, free, mix, stream

LENGTH = 50
GRAM = 18
SPAN = LENGTH - GRAM + 1
LEFT = (SPAN - 1) // 2
RIGHT = SPAN - LEFT
BUCKET_BYTES = 8 << 20
FLUSH_BYTES = 6 << 20
PIECE = 1 << 16  # bytes that are hashed at once, so that they stay in a processor's own cache
WINDOWS = 1 << 18  # strings that are sorted at once, or those of one anchor at one place
LAST_ID = (1 << 63) - 1

_BYTES = stream(6, 256)
_BASE = int(stream(7, 1)[0])
_K = stream(8, 4)


def hashes_of(data):
    return Hashes(data, _BYTES, _BASE)


def runs(offsets, data, hashes):
    """Runs of strings with one anchor: ``(text, start, size, anchor)``; sizes in bytes."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    grams = len(data) - GRAM + 1
    at = np.arange(grams, dtype=np.uint64)
    # The upper half of the hash, then the place: the least has the leftmost place among equals.
    least = (mix(hashes.of(slice(0, grams), slice(GRAM, grams + GRAM))) >> np.uint64(32) << np.uint64(32)) | at
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[:n], least[SPAN - width:SPAN - width + n])
    anchor = (least[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Strings do not cross from text to text.
    lengths = np.diff(offsets)
    valid = np.zeros(len(data) + 1, dtype=np.int8)
    long = lengths >= LENGTH
    valid[offsets[:-1][long]] = 1
    valid[offsets[1:][long] - LENGTH + 1] -= 1
    place = np.flatnonzero(np.cumsum(valid[:n], dtype=np.int8))
    own = anchor[place]
    first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (place[1:] != place[:-1] + 1)][:len(own)])
    last = np.r_[first[1:] - 1, len(own) - 1][:len(first)]
    start, size = place[first], place[last] - place[first] + LENGTH
    return np.searchsorted(offsets, start, side="right") - 1, start, size, own[first]


RUN = np.dtype([("anchor", "<u4"), ("run", "<u4"), ("shape", "<u4"), ("left", "<u2"), ("right", "<u2"), ("start", "<u4"), ("id", "<i8"), ("tag", "<u2")])
SPANS = np.dtype([("id", "<i8"), ("tag", "<u2"), ("start", "<u4"), ("end", "<u4")])
PART = np.dtype([("anchor", "<u4"), ("offset", "u1"), ("size", "u1"), ("start", "<u4"), ("id", "<i8"), ("tag", "<u2")])


def run_key(bucket, rows):
    """Key of a run's content."""
    joint = (rows["anchor"].astype(np.uint64) << np.uint64(32)) | rows["run"]
    sides = (rows["left"].astype(np.uint64) << np.uint64(16)) | rows["right"]
    return mix(mix(joint * _K[0] + rows["shape"].astype(np.uint64) * _K[1] + np.asarray(bucket).astype(np.uint64) * _K[2]) + sides * _K[3])


def side_key(bucket, rows, side):
    """Key of a side's anchor and bytes, for the filter."""
    joint = (rows["anchor"].astype(np.uint64) << np.uint64(32)) | rows[side]
    return mix(joint * _K[0] + np.uint64(side == "right") * _K[1] + np.asarray(bucket).astype(np.uint64) * _K[3])


def has_side(rows, side):
    """Whether the runs have strings of the side."""
    offset = rows["shape"] & np.uint32(255)
    if side == "left":
        return offset >= LEFT
    return (rows["shape"] >> np.uint32(8) & np.uint32(255)) - offset >= GRAM + RIGHT


def _pieces(offsets, data):
    """A block in pieces of whole texts: ``(first, offsets, data)``."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + PIECE, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, offsets[first:last + 1] - offsets[first], data[offsets[first]:offsets[last]]
        first = last


def _described(ids, tags, first, offsets, data, hashes, buckets):
    """The runs of a block as ``RUN`` rows, their buckets, and the places of the runs and anchors in the block."""
    text, start, size, anchor = runs(offsets, data, hashes)
    gram = mix(hashes.of(anchor, anchor + GRAM))
    whole = mix(hashes.of(start, start + size) + size.astype(np.uint64))
    rows = np.empty(len(text), dtype=RUN)
    rows["anchor"], rows["run"] = gram & np.uint64(0xFFFFFFFF), whole & np.uint64(0xFFFFFFFF)
    rows["shape"] = (whole >> np.uint64(48) << np.uint64(16)) | (size.astype(np.uint64) << np.uint64(8)) | (anchor - start).astype(np.uint64)
    rows["start"], rows["id"], rows["tag"] = start - offsets[text], ids[text + first], tags[text + first]
    # Where a run does not have the side, its bytes are not asked for.
    rows["left"] = mix(hashes.of(np.maximum(anchor - LEFT, 0), anchor)) & np.uint64(0xFFFF)
    rows["right"] = mix(hashes.of(anchor + GRAM, np.minimum(anchor + GRAM + RIGHT, len(data)))) & np.uint64(0xFFFF)
    for side in ("left", "right"):
        rows[side][~has_side(rows, side)] = 0
    return rows, ((gram >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), start, anchor


def _edges(values):
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else np.zeros(1, np.int64)


def _blobs(kind, bucket, rows, extra=None):
    """Arrow rows ``(kind, bucket, blob, more)``, one a bucket. ``extra`` gives the second blob of row numbers."""
    import pyarrow as pa

    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], rows[order]
    edges = _edges(bucket)
    pairs = list(zip(edges[:-1], edges[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(pairs), pa.int32()), pa.array(bucket[edges[:-1]].astype(np.int32)),
         pa.array([_pack(rows[a:b]) for a, b in pairs], pa.binary()),
         pa.array([extra(order[a:b]) if extra else b"" for a, b in pairs], pa.binary())], names=["kind", "bucket", "blob", "more"])


BLOBS = "kind int, bucket int, blob binary, more binary"
SENT, COVERED, KEYS = 0, 1, 2


def _columns(batch):
    return batch.column("id").to_numpy(), batch.column("tag").to_numpy().astype(np.uint16)


def _send(buckets):
    """All runs, to the bucket of their anchor."""
    def send(batches):
        for batch in batches:
            ids, tags = _columns(batch)
            found, size = [], 0
            for first, offsets, data in blocks(batch.column("text")):
                for more, places, own in _pieces(offsets, data):
                    found.append(_described(ids, tags, first + more, places, own, hashes_of(own), buckets)[:2])
                size += len(data)
                if size >= FLUSH_BYTES:
                    yield _sent(found)
                    found, size = [], 0
            if found:
                yield _sent(found)
            del found
            free()
    return send


def _sent(found):
    rows, bucket = (np.concatenate(x) for x in zip(*found))
    return _blobs(SENT, bucket, rows)


def _by_bucket(work):
    """Task function: ``work(bucket, blobs, more)`` yields the batches of each bucket of rows sorted by bucket."""
    def run(batches):
        held, blobs, more = None, [], []
        for batch in batches:
            for bucket, blob, other in zip(*(batch.column(c).to_pylist() for c in ("bucket", "blob", "more"))):
                if held not in (None, bucket):
                    yield from work(held, blobs, more)
                    blobs, more = [], []
                held = bucket
                blobs.append(blob)
                more.append(other)
        if held is not None:
            yield from work(held, blobs, more)
        del blobs, more
        free()
    return run


def _doc_bucket(ids, buckets):
    return (mix(ids.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _meet(buckets):
    """Runs that a smaller document has in full are covered; sides that different runs have go on. Spans go to ``buckets``."""
    def work(bucket, blobs, more):
        rows = _columns_of(blobs, RUN)
        joint = (rows["anchor"].astype(np.uint64) << np.uint64(32)) | rows["run"]
        rest = (rows["shape"].astype(np.uint64) << np.uint64(32)) | (rows["left"].astype(np.uint64) << np.uint64(16)) | rows["right"]
        order = np.argsort(joint)
        alike = joint[order[1:]] == joint[order[:-1]]
        if (rest[order[1:]] != rest[order[:-1]])[alike].any():
            order = np.lexsort((rest, joint))
        joint, rest, ids = joint[order], rest[order], rows["id"][order]
        first = np.flatnonzero(np.r_[True, (joint[1:] != joint[:-1]) | (rest[1:] != rest[:-1])])
        least = np.minimum.reduceat(ids, first)
        covered = order[ids > np.repeat(least, np.diff(np.r_[first, len(ids)]))]
        if len(covered):
            spans = np.empty(len(covered), dtype=SPANS)
            for name in ("id", "tag", "start"):
                spans[name] = rows[name][covered]
            spans["end"] = spans["start"] + (rows["shape"][covered] >> np.uint32(8) & np.uint32(255))
            yield _blobs(COVERED, _doc_bucket(spans["id"], buckets), spans)
        # Sides that several contents have, with a smaller document among them.
        reps, keys = {name: rows[name][order[first]] for name in ("anchor", "shape", "left", "right")}, []
        for side in ("left", "right"):
            own = np.flatnonzero(has_side(reps, side))
            if not len(own):
                continue
            joint = (reps["anchor"][own].astype(np.uint64) << np.uint64(16)) | reps[side][own]
            order = np.argsort(joint)
            own, edges = own[order], _edges(joint[order])[:-1]
            is_open = np.minimum.reduceat(least[own], edges) < np.maximum.reduceat(least[own], edges)
            some = own[edges[is_open]]
            keys.append(side_key(np.full(len(some), bucket), {name: reps[name][some] for name in ("anchor", side)}, side))
        keys = np.concatenate(keys) if keys else keys
        if len(keys):
            import pyarrow as pa

            yield pa.RecordBatch.from_arrays(
                [pa.array([KEYS], pa.int32()), pa.array([bucket], pa.int32()), pa.array([keys.astype("<u8").tobytes()], pa.binary()),
                 pa.array([b""], pa.binary())], names=["kind", "bucket", "blob", "more"])
    return _by_bucket(work)


def _keys(batches):
    import pyarrow as pa

    for batch in batches:
        for blob in batch.column("blob").to_pylist():
            cells = np.concatenate(_probes(np.frombuffer(blob, dtype="<u8")))
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype("<i8"))], names=["key"])


def _probes(keys):
    return [keys, mix(keys + _K[0]), mix(keys + _K[1])]


def probed(bits, keys):
    """Whether the filter may hold the keys: three cells each."""
    out = in_filter(bits, keys)
    held = np.flatnonzero(out)
    for cells in _probes(keys[held])[1:]:
        out[held] &= in_filter(bits, cells)
    return out


def _ragged(data, begin, size):
    """The bytes of all pieces, none much longer than another, one after the other."""
    if not len(begin):
        return data[:0]
    width = int(size.max())
    wide = np.lib.stride_tricks.sliding_window_view(np.r_[data, np.zeros(width, np.uint8)], width)[begin]
    return wide[np.arange(width) < size[:, None]]


def _open_parts(ids, tags, first, offsets, data, buckets, bits):
    """The open sides of the runs of a piece: their buckets, ``PART`` rows and bytes; of equal runs those of the smallest document."""
    hashes = hashes_of(data)
    rows, bucket, start, anchor = _described(ids, tags, first, offsets, data, hashes, buckets)
    asked = {side: has_side(rows, side) & probed(bits, side_key(bucket, rows, side)) for side in ("left", "right")}
    good = np.flatnonzero(asked["left"] | asked["right"])
    key = run_key(bucket[good], rows[good])
    order = np.argsort(key, kind="stable")
    good, edges = good[order], _edges(key[order])
    if len(good):
        least = np.repeat(np.minimum.reduceat(rows["id"][good], edges[:-1]), np.diff(edges))
        good = np.sort(good[rows["id"][good] == least])
    found = []
    for side in ("left", "right"):
        own = good[asked[side][good]]
        at, run = anchor[own], rows[own]
        offset = (run["shape"] & np.uint32(255)).astype(np.int64)
        size = (run["shape"] >> np.uint32(8) & np.uint32(255)).astype(np.int64)
        if side == "left":
            context = hashes.of(at - LEFT, at + GRAM)
            size = np.minimum(offset - LEFT + LENGTH, size)
        else:
            context = hashes.of(at, at + GRAM + RIGHT) + _K[3]
            size = size - np.maximum(offset - LEFT + 1, 0)
            offset = np.minimum(offset, LEFT - 1)
        context = mix(context)
        parts = np.empty(len(own), dtype=PART)
        parts["anchor"], parts["offset"], parts["size"] = context & np.uint64(0xFFFFFFFF), offset, size
        parts["start"], parts["id"], parts["tag"] = run["start"] + (at - offset - start[own]).astype(np.uint32), run["id"], run["tag"]
        found.append((((context >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), parts, _ragged(data, at - offset, size)))
    return found


def _send_parts(buckets, wanted):
    """The bytes of the sides that the filter holds."""
    def send(batches):
        for batch in batches:
            ids, tags = _columns(batch)
            found, size = [], 0
            for first, offsets, data in blocks(batch.column("text")):
                for more, places, own in _pieces(offsets, data):
                    found += [x for x in _open_parts(ids, tags, first + more, places, own, buckets, wanted.value) if len(x[0])]
                size += len(data)
                if size >= FLUSH_BYTES:
                    yield from _sent_parts(found)
                    found, size = [], 0
            yield from _sent_parts(found)
            del found
            free()
    return send


def _sent_parts(found):
    if not found:
        return
    bucket, parts, data = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(bucket, kind="stable")
    bucket, sorted_parts = bucket[order], parts[order]
    data = _ragged(data, (np.cumsum(parts["size"], dtype=np.int64) - parts["size"])[order], sorted_parts["size"])
    ends = np.r_[0, np.cumsum(sorted_parts["size"], dtype=np.int64)]
    yield _blobs(SENT, bucket, sorted_parts, lambda own: data[ends[own[0]]:ends[own[-1] + 1]].tobytes())


class Suffixes:
    """Suffixes of byte strings, compared by their first ``LENGTH`` bytes."""

    #: Where the words of eight bytes begin that are compared in turn; the last two overlap.
    WORDS = [*range(0, LENGTH - 8, 8), LENGTH - 8]

    def __init__(self, data, hashes=None):
        self.data, self.hashes, self.windows = np.ascontiguousarray(data), hashes, None
        # The word at every byte.
        self.words = np.ndarray((max(len(data) - 7, 0),), dtype=">u8", buffer=self.data, strides=(1,))

    def hash(self, at):
        """Hashes of the first ``LENGTH`` bytes; found in pieces, as one anchor may have many bytes."""
        if self.hashes:
            return self.hashes.of(at, at + LENGTH)
        if self.windows is None:
            self.windows = np.empty(len(self.data) - LENGTH + 1, dtype=np.uint64)
            for a in range(0, len(self.windows), PIECE):
                own = hashes_of(self.data[a:a + PIECE + LENGTH - 1])
                n = len(own.sums) - LENGTH
                self.windows[a:a + PIECE] = own.of(slice(0, n), slice(LENGTH, LENGTH + n))
        return self.windows[at]

    def sort(self, at, edges):
        """Order of the suffixes ``at`` within each group: all groups at once by a word, then what is still equal by the next."""
        sizes = np.diff(edges)
        order, number = np.arange(len(at)), np.repeat(np.arange(len(sizes)), sizes)
        todo = np.flatnonzero(sizes[number] > 1)
        number = number[todo]
        for skip in self.WORDS:
            if not len(todo):
                break
            own = order[todo]
            word = self.words[at[own] + skip].astype(np.uint64)
            place = np.lexsort((word, number))
            order[todo], word = own[place], word[place]
            new = np.r_[True, (number[1:] != number[:-1]) | (word[1:] != word[:-1])]
            tied = np.flatnonzero(~new | np.r_[~new[1:], False])
            todo, number = todo[tied], np.cumsum(new)[tied]
        return order

    def equal_groups(self, at, edges):
        """Number of each suffix's group of equals of ``LENGTH`` bytes within its group."""
        order = self.sort(at, edges)
        new = np.zeros(len(at), dtype=bool)
        new[edges[:-1]] = True
        for skip in self.WORDS:
            here = np.flatnonzero(~new)
            new[here] = self.words[at[order[here - 1]] + skip] != self.words[at[order[here]] + skip]
        number = np.empty(len(at), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        return number

    def repeated(self, at):
        """Numbers of the suffixes that share their hash with another."""
        value = self.hash(at)
        order = np.argsort(value)
        edges = _edges(value[order])
        return np.sort(order[np.repeat(np.diff(edges) > 1, np.diff(edges))])


def _resolve(buckets):
    """Strings of the open sides that a smaller document has too. Spans go to ``buckets``."""
    def work(bucket, blobs, more):
        rows = _unpack(blobs, PART)
        data = np.frombuffer(b"".join(more), dtype=np.uint8)
        base = np.cumsum(rows["size"], dtype=np.int64) - rows["size"]
        order = np.argsort(rows["anchor"], kind="stable")
        rows, base = rows[order], base[order]
        # An anchor with rows of one document only has nothing to find.
        edges = _edges(rows["anchor"])
        several = np.minimum.reduceat(rows["id"], edges[:-1]) < np.maximum.reduceat(rows["id"], edges[:-1])
        good = np.repeat(several, np.diff(edges))
        rows, base = rows[good], base[good]
        # Anchors in turn, so many that their strings fit.
        strings = np.cumsum(rows["size"].astype(np.int64) - LENGTH + 1)
        edges, low, found = _edges(rows["anchor"]), 0, []
        while low < len(rows):
            done = strings[low - 1] if low else 0
            high = edges[max(np.searchsorted(strings[edges[1:] - 1], done + WINDOWS, side="right"), np.searchsorted(edges, low, side="right"))]
            own = _ragged(data, base[low:high], rows["size"][low:high])
            size = rows["size"][low:high].astype(np.int64)
            found.append(_spans(rows[low:high], own, np.cumsum(size) - size))
            low = high
        spans = np.concatenate(found) if found else np.zeros(0, dtype=SPANS)
        if len(spans):
            yield _blobs(COVERED, _doc_bucket(spans["id"], buckets), spans)
    return _by_bucket(work)


def _classes(rows, data, base, suffixes):
    """Order of the rows by anchor, offset, content and document, and which of them begin a class of equals."""
    size = rows["size"].astype(np.int64)
    content = mix(suffixes.hash(base) * _K[0] + suffixes.hash(base + size - LENGTH) + size.astype(np.uint64) * _K[1])

    def by(content):
        order = np.lexsort((rows["id"], rows["offset"], content, rows["anchor"]))
        new = np.ones(len(rows), dtype=bool)
        for values in (rows["anchor"], content, rows["offset"]):
            new[1:] &= values[order[1:]] == values[order[:-1]]
        new[1:] = ~new[1:]
        return order, new

    order, new = by(content)
    later = np.flatnonzero(~new)
    a, b = order[later - 1], order[later]
    if (size[a] != size[b]).any() or (_ragged(data, base[a], size[a]) != _ragged(data, base[b], size[b])).any():
        # A collision: the bytes themselves decide.
        raw, numbers = data.tobytes(), {}
        content = np.array([numbers.setdefault(raw[i:i + n], len(numbers)) for i, n in zip(base.tolist(), size.tolist())], dtype=np.int64)
        order, new = by(content)
    return order, new


def _as_spans(rows, start, end):
    spans = np.empty(len(rows), dtype=SPANS)
    spans["id"], spans["tag"], spans["start"], spans["end"] = rows["id"], rows["tag"], rows["start"] + start, rows["start"] + end
    return spans


def _spans(rows, data, base):
    """What smaller documents have of the sides ``rows``, whose bytes begin at ``base`` in ``data``."""
    suffixes = Suffixes(data)
    order, new = _classes(rows, data, base, suffixes)
    rows, base = rows[order], base[order]
    first, of = np.flatnonzero(new), np.cumsum(new) - 1
    least = rows["id"][first]
    covered = rows[rows["id"] > least[of]]
    found = [_as_spans(covered, np.zeros(len(covered), dtype=np.uint32), covered["size"])]
    count, offset, anchor = rows["size"][first].astype(np.int64) - LENGTH + 1, rows["offset"][first].astype(np.int64), rows["anchor"][first]
    # Classes that meet another one with another smallest document.
    edges = _edges(anchor)
    mixed = np.minimum.reduceat(least, edges[:-1]) < np.maximum.reduceat(least, edges[:-1])
    live = np.flatnonzero(np.repeat(mixed, np.diff(edges)))
    # Strings that are equal lie at one place to the anchor: so many places at once that their strings fit.
    hits, high = [], SPAN
    while high and len(live):
        low = max(0, high - max(1, WINDOWS // len(live)))
        begin, end = np.maximum(offset[live] - high + 1, 0), np.minimum(offset[live] - low + 1, count[live])
        hits.append(_repeats(suffixes, live, begin, np.maximum(end - begin, 0), anchor, offset, base[first], least))
        high = low
    c, at = (np.concatenate(x) for x in zip(*hits)) if hits else (np.zeros(0, np.int64),) * 2
    order = np.lexsort((at, c))
    c, at = c[order], at[order]
    # Strings in a row make one span, for every place of the class in its smallest document.
    begin = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (c[1:] != c[:-1])][:len(at)])
    finish = np.r_[begin[1:] - 1, len(at) - 1][:len(begin)]
    c, low, high = c[begin], at[begin], at[finish] + LENGTH
    targets = np.flatnonzero(rows["id"] == least[of])
    lo, hi = np.searchsorted(of[targets], c), np.searchsorted(of[targets], c, side="right")
    span = np.repeat(np.arange(len(c)), hi - lo)
    row = targets[np.arange(len(span)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[span]]
    found.append(_as_spans(rows[row], low[span].astype(np.uint32), high[span].astype(np.uint32)))
    return np.concatenate(found)


def _repeats(suffixes, classes, begin, count, anchor, offset, base, least):
    """Strings ``(class, step)`` that a smaller document has, of ``count`` strings of each class from the step ``begin`` on."""
    c = np.repeat(classes, count)
    step = np.arange(len(c)) - np.repeat(np.cumsum(count) - count - begin, count)
    some = suffixes.repeated(base[c] + step)
    c, step = c[some], step[some]
    place = offset[c] - step
    order = np.lexsort((place, anchor[c]))
    c, step, place = c[order], step[order], place[order]
    if not len(c):
        return c, step
    edges = np.flatnonzero(np.r_[True, (anchor[c[1:]] != anchor[c[:-1]]) | (place[1:] != place[:-1]), True])
    number = suffixes.equal_groups(base[c] + step, edges)
    smallest = np.full(number.max() + 1, LAST_ID)
    np.minimum.at(smallest, number, least[c])
    hit = smallest[number] < least[c]
    return c[hit], step[hit]


def _merge(bucket, blobs, more):
    """Spans of each document, joined where they touch."""
    import pyarrow as pa

    rows = _unpack(blobs, SPANS)
    rows = rows[np.lexsort((rows["start"], rows["tag"], rows["id"]))]
    doc = np.r_[True, (rows["id"][1:] != rows["id"][:-1]) | (rows["tag"][1:] != rows["tag"][:-1])]
    number = np.cumsum(doc) - 1
    # The farthest end so far, within a document: shift the documents apart.
    shift = number * (1 << 33)
    reach = np.maximum.accumulate(rows["end"].astype(np.int64) + shift)
    begin = rows["start"].astype(np.int64) + shift
    new = np.r_[True, begin[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(rows) - 1]
    starts, ends = rows["start"][first].astype(np.int64), reach[last] - shift[first]
    docs = np.flatnonzero(doc)
    edges = np.r_[np.searchsorted(first, docs), len(first)].astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x)) for x in (starts, ends)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows["id"][docs]), pa.array(rows["tag"][docs].astype(np.int32)), *lists], names=["id", "tag", "starts", "ends"])


def repeated_spans(df: DataFrame, id="doc_id", text="text") -> DataFrame:
    """Spans to remove, ``(id, tag, starts, ends)`` in bytes, of documents that have any; see ``remove_repeats``."""
    spark = df.sparkSession
    docs = df.select(F.coalesce(F.col(id).cast("bigint"), F.lit(LAST_ID)).alias("id"), _tag(F.col(text)).alias("tag"),
                     F.col(text).alias("text")).where(F.octet_length("text") >= LENGTH)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    # A document's spans are few beside its bytes, and every bucket writes to every one of theirs.
    held = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (4 * BUCKET_BYTES)))

    def dealt(frame, n=buckets):
        return frame.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket")

    met = materialise(dealt(docs.mapInArrow(_send(buckets), BLOBS)).mapInArrow(_meet(held), BLOBS), "runs")
    keys = met.where(F.col("kind") == KEYS).select("blob").mapInArrow(_keys, "key bigint")
    wanted = Shared(spark, key_filter(keys, "key"))
    parts = dealt(docs.mapInArrow(_send_parts(buckets, wanted), BLOBS)).mapInArrow(_resolve(held), BLOBS)
    spans = met.where(F.col("kind") == COVERED).union(parts)
    return dealt(spans, held).mapInArrow(_by_bucket(_merge), "id bigint, tag int, starts array<bigint>, ends array<bigint>")


def _tag(text):
    """Tells texts of a repeated id apart."""
    return F.xxhash64(text).bitwiseAND(0xFFFF).cast("int")


def remove_repeats(df: DataFrame, id="doc_id", text="text") -> DataFrame:
    """Add ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary: the UTF-8 bytes that stay).

    A byte goes if a string of 50 bytes covers it that also starts in a document
    with a smaller id; overlaps count, and strings are judged on the input. ``id``
    is an integer column; a null id comes after all others, and rows that repeat an
    id are not smaller than each other. A null or short text keeps all it has; the
    bytes kept of a cut text need not be whole characters. A text is held whole in
    one task, with some 60 bytes of working memory for each of its own. Other
    columns stay; those named like the new ones become ``<name>_in``. An empty
    table gives no rows.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept"]
    if {id.lower(), text.lower()} & set(added):
        raise ValueError("the id and text columns may not be named like the new ones")
    df = free_of(df, *added)
    s_id, s_tag, starts, ends = names_for(df, "span_id", "span_tag", "span_starts", "span_ends")
    spans = repeated_spans(df, id, text).toDF(s_id, s_tag, starts, ends)
    same = (F.coalesce(F.col(id).cast("bigint"), F.lit(LAST_ID)) == F.col(s_id)) & (_tag(F.col(text)) == F.col(s_tag))
    joined = df.join(spans.hint("merge"), same, "left")

    @F.pandas_udf("binary")
    def cut(texts, begins, stops):
        import pandas as pd

        # The workers of earlier stages go on with this one.
        forget()
        free()
        out = []
        for value, begin, stop in zip(texts, begins, stops):
            raw = (value or "").encode()
            if begin is not None and len(begin):
                at = [0, *(int(x) for pair in zip(begin, stop) for x in pair), len(raw)]
                raw = b"".join(raw[a:b] for a, b in zip(at[::2], at[1::2]))
            out.append(raw)
        return pd.Series(out)

    removed = F.aggregate(F.zip_with(F.col(ends), F.col(starts), lambda e, s: e - s), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return (joined.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"))
            .withColumn("n_removed", F.coalesce(removed, F.lit(0)).cast("bigint"))
            .withColumn("n_spans", F.coalesce(F.size(starts), F.lit(0)).cast("bigint"))
            .withColumn("kept", cut(F.col(text), F.col(starts), F.col(ends))).drop(s_id, s_tag, starts, ends))
