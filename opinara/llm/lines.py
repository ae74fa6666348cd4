"""Line dedup by an exact set-similarity join (op 5).

A line's tokens are its distinct words, ordered from rare to common. Two sets that
reach the threshold share a token among their first few, so lines meet only at
the tokens of these prefixes. Sizes, the places of the shared token and a parity
sketch of the sets rule out most pairs without ever ruling out a match; the rest
are settled on the full sets. Whatever matches an earlier line goes.

Rarity comes from word counts in a fixed number of cells, so that the table of
counts has a proven size. Any order of the tokens gives the same matches; only
the work differs.
"""

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vocabulary import let
from .common import Shared, drop_others, free_of, materialise, names_for, possibly_in
from .words import blocks, mix, stream, word_hashes, word_places

CELL_BITS = 20
CELLS = 1 << CELL_BITS
SLICES = 16
BUCKET_BYTES = 4 << 20
FLUSH_BYTES = 2 << 20
FIRST = 2
WIDEN = 16
WIDEST = 8
TRIES = 16  # pairs of a line that are tried at once, at first
PAIRS = 1 << 17  # pairs at once
FILTER_BITS = 1 << 27  # 16 MB: filters of wanted classes that are sent to all tasks
BITMAP = 32768
LAST_ID = (1 << 63) - 1

_K = stream(5, 4)
_LOW = (np.uint64((1 << 48) - 1), np.uint64((1 << 40) - 1))


class Lines:
    """The lines of a block of texts that have words: their sets of tokens, each from rare to common.

    A token is 40 bits of its word's hash; sets are told apart by 48.
    """

    def __init__(self, offsets, data, counts, asked=None):
        """With a filter ``asked`` of mixed tokens, only the lines that have one in it."""
        self.text, self.number, line, hashes = lines_of(offsets, data)
        if asked is not None:
            good = np.zeros(len(self.text), dtype=bool)
            good[line[in_filter(asked, mix(hashes >> np.uint64(24)))]] = True
            self.text, self.number = self.text[good], self.number[good]
            own = good[line]
            line, hashes = (np.cumsum(good) - 1)[line[own]], hashes[own]
        tokens, self.n, parity, check, other = [], [], [], [], []
        for a in range(0, len(self.text), 1 << 16):
            low, high = np.searchsorted(line, (a, a + (1 << 16)))
            at = (line[low:high] - a).astype(np.uint64) << np.uint64(48)
            whole = np.sort(at | (hashes[low:high] >> np.uint64(16)))
            whole = whole[np.r_[True, whole[1:] != whole[:-1]]]
            at, word = whole & ~_LOW[0], whole & _LOW[0]
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            self.n.append(np.diff(np.r_[first, len(at)]))
            parity.append(sketches(word, first, self.n[-1]))
            check.append((np.add.reduceat(mix(word ^ _K[0]), first) >> np.uint64(32)).astype(np.uint32))
            other.append(np.add.reduceat(mix(word + _K[1]), first))
            if counts is not None:
                rarity = counts[(word >> np.uint64(48 - CELL_BITS)).view(np.int64)]
                tokens.append(np.sort(at | (rarity << np.uint64(40)) | (word >> np.uint64(8))) & _LOW[1])

        def joined(parts, kind):
            return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)

        self.tokens, self.n = joined(tokens, np.uint64), joined(self.n, np.int64)
        self.parity = np.concatenate(parity) if parity else np.zeros((0, WIDEST), dtype=np.uint64)
        self.check, self.other = joined(check, np.uint32), joined(other, np.uint64)
        self.first = np.cumsum(self.n) - self.n


def width_of(n):
    """64-bit parts of the sketch of a set of ``n`` tokens: wide enough to tell it from others of its size."""
    return np.where(n > 300, 8, np.where(n > 128, 4, np.where(n > 48, 2, 1)))


def sketches(word, first, n):
    """Parity sketches: bit i tells whether an odd number of tokens fall on i. Parts beyond a set's width are 0.

    Where two sketches differ the sets differ, by a token a bit at least.
    """
    out = np.zeros((len(n), WIDEST), dtype=np.uint64)
    spread = mix(word)
    bit = np.uint64(1) << (spread & np.uint64(63))
    out[:, 0] = np.bitwise_xor.reduceat(bit, first)
    wide = width_of(n)
    own = np.flatnonzero(wide > 1)
    if not len(own):
        return out
    # The tokens of the wide sets only, each on its own part.
    size = n[own]
    begin = np.cumsum(size) - size
    at = np.repeat(first[own] - begin, size) + np.arange(size.sum())
    part, bit = (spread[at] >> np.uint64(6)) & np.repeat(wide[own] - 1, size).astype(np.uint64), bit[at]
    for k in range(wide.max()):
        out[own, k] = np.bitwise_xor.reduceat(np.where(part == k, bit, np.uint64(0)), begin)
    return out


def apart(x, y, wide_x, wide_y):
    """Tokens at least in which the sets of two rows of sketches differ; the wider one is folded to the other's width."""
    out = np.bitwise_count(x[:, 0] ^ y[:, 0]).astype(np.int64)
    least = np.where((wide_x == 1) & (wide_y == 1), 0, np.minimum(wide_x, wide_y))
    for width in (1, 2, 4, 8):
        own = np.flatnonzero(least == width)
        if len(own):
            a, b = (np.bitwise_xor.reduce(z[own].reshape(len(own), WIDEST // width, width), axis=1) for z in (x, y))
            out[own] = np.bitwise_count(a ^ b).sum(axis=1)
    return out


def ends_of_lines(offsets, data):
    """All lines, with words or without: ``(text, number in the text, start)`` of each."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    texts = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.argsort(texts, kind="stable")  # a text's first line, then those after its breaks
    text = texts[order]
    number = np.arange(len(text)) - np.searchsorted(text, np.arange(len(offsets) - 1))[text]
    return text, number, starts[order]


def lines_of(offsets, data):
    """Lines with words: ``(text, number in the text)`` of each, and ``(line, hash)`` of each word."""
    text, number, begin = ends_of_lines(offsets, data)
    hashes, starts, _ = word_hashes(offsets, data)  # a line feed ends a word by itself
    n = np.diff(np.append(np.searchsorted(starts, begin), len(starts)))
    own = n > 0
    return text[own], number[own], np.repeat(np.arange(own.sum()), n[own]), hashes


def prefix(n, percent):
    """Tokens of a set of ``n`` that are looked up; none where only equal sets can match."""
    least = -(-percent * n // 100)
    alone = (100 * n // percent == n) & (least == n)
    return np.where(alone, 0, n - least + 1)


def place_key(ids, tags, numbers):
    """Key of a line by where it stands."""
    return mix(mix(ids.astype(np.uint64) + _K[2]) + (tags.astype(np.uint64) << np.uint64(32)) + numbers.astype(np.uint64))


def token_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How common words are, by cell, in eighths of a doubling, and the bytes of all texts; a bounded table, added up in slices."""
    def count(batches):
        import pyarrow as pa

        drop_others()
        total, size = np.zeros(CELLS, dtype=np.int64), 0
        for batch in batches:
            for _, offsets, data in blocks(batch.column("text")):
                size += len(data)
                hashes, _, _ = word_hashes(offsets, data)
                total += np.bincount((hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=CELLS)
        for i, part in enumerate([*np.split(total, SLICES), np.array([size])]):
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["slice", "counts"])

    def add(batches):
        import pyarrow as pa

        sums = {}
        for batch in batches:
            for i, part in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                part = np.frombuffer(zlib.decompress(part), dtype=np.int64)
                sums[i] = sums[i] + part if i in sums else part
        for i, part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "counts"])

    schema = "slice int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema).collect()
    total = np.zeros((SLICES, CELLS // SLICES), dtype=np.int64)
    size = 0
    for row in parts:  # the same 8 MB at any size
        part = np.frombuffer(row["counts"], dtype=np.int64)
        if row["slice"] < SLICES:
            total[row["slice"]] = part
        else:
            size = int(part[0])
    return np.minimum(8 * np.log2(total.ravel() + 1), 255).astype(np.uint64), size


def needed(n, m, percent):
    """Least overlap of sets of sizes ``n`` and ``m`` that reach the threshold."""
    return -(-percent * (n + m) // (100 + percent))


TOKEN = {"token": "<u4", "place": "<u4", "n": "<u4", "number": "<u4", "check": "<u4", "id": "<i8", "tag": "<u4"}
LINE = np.dtype([("number", "<u4"), ("key", "<u8"), ("other", "<u8"), ("id", "<i8"), ("text_hash", "<i8")])


def _planes(values):
    """The bytes of an array, plane by plane."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T).tobytes()


def _pack(rows):
    """The bytes of all fields, plane by plane, so that the many bytes that are alike stand together."""
    return b"".join(_planes(rows[name]) for name in rows.dtype.names)


def _pack_tokens(columns, wide, a, b):
    """Token rows ``a`` to ``b`` with their number in front. Of a sketch only the parts its set has; random bytes stay as they are."""
    out = [np.array([b - a], dtype="<u4").tobytes()]
    for name in ("place", "n", "number", "id"):
        out.append(_planes(columns[name][a:b]))
    for name in ("token", "check", "tag"):
        out.append(columns[name][a:b].tobytes())
    for k in range(WIDEST):
        own = wide[a:b] > k
        if not own.any():
            break
        out.append(columns["sketch"][a:b, k][own].tobytes())
    return b"".join(out)


def _unpack_tokens(blobs):
    """The fields of all blobs of ``_pack_tokens``, an array each; ``sketch`` has the parts side by side."""
    sizes = [int(np.frombuffer(blob, dtype="<u4", count=1)[0]) for blob in blobs]
    total, place = sum(sizes), [4] * len(blobs)
    columns = {name: np.empty(total, dtype=kind) for name, kind in TOKEN.items()}
    columns["sketch"] = np.zeros((total, WIDEST), dtype=np.uint64)

    def take(i, kind, count):
        out = np.frombuffer(blobs[i], dtype=kind, count=count, offset=place[i])
        place[i] += out.nbytes
        return out

    edges = np.cumsum([0, *sizes]).tolist()
    for name in ("place", "n", "number", "id", "token", "check", "tag"):
        kind = columns[name].dtype
        for i, n in enumerate(sizes):
            own = columns[name][edges[i]:edges[i + 1]]
            if name in ("place", "n", "number", "id"):
                own.view(np.uint8).reshape(n, kind.itemsize)[:] = take(i, np.uint8, n * kind.itemsize).reshape(kind.itemsize, n).T
            else:
                own[:] = take(i, kind, n)
    wide = width_of(columns["n"])
    for k in range(WIDEST):
        for i in range(len(blobs)):
            own = np.flatnonzero(wide[edges[i]:edges[i + 1]] > k)
            if len(own):
                columns["sketch"][edges[i] + own, k] = take(i, "<u8", len(own))
    return columns


def _unpack(blobs, dtype):
    columns = _columns_of(blobs, dtype)
    out = np.empty(len(columns[dtype.names[0]]), dtype=dtype)
    for name, values in columns.items():
        out[name] = values
    return out


def _columns_of(blobs, dtype):
    """The fields of all blobs, an array each."""
    sizes = [len(b) // dtype.itemsize for b in blobs]
    columns, place = {}, [0] * len(blobs)
    for name in dtype.names:
        field = dtype[name]
        values, at = np.empty((sum(sizes), field.itemsize), dtype=np.uint8), 0
        for i, (blob, n) in enumerate(zip(blobs, sizes)):
            values[at:at + n] = np.frombuffer(blob, dtype=np.uint8, count=n * field.itemsize, offset=place[i]).reshape(field.itemsize, n).T
            place[i] += n * field.itemsize
            at += n
        columns[name] = values.view(field).ravel()
    return columns


def _exchange(docs, counts, buckets, percent, tokens=None):
    """Send lines by set and prefix tokens by token to their bucket, in blobs: ``(kind, bucket, blob)``.

    With a filter ``tokens`` only the tokens in it go.
    """
    def send(batches):
        import pyarrow as pa

        def out(kind, bucket, rows):
            # Numbers of 16 bits are sorted by counting.
            order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32), kind="stable")
            bucket = bucket[order]
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else [0]
            if kind == 0:
                rows = rows[order]
                blobs = [_pack(rows[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            else:
                rows = {name: values[order] for name, values in rows.items()}
                wide = width_of(rows["n"])
                blobs = [_pack_tokens(rows, wide, a, b) for a, b in zip(edges[:-1], edges[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(blobs), pa.int32()), pa.array(bucket[edges[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())],
                names=["kind", "bucket", "blob"])

        def flushed(line_rows, token_rows, token_buckets):
            if line_rows:
                rows = np.concatenate(line_rows)
                yield out(0, (rows["key"] % np.uint64(buckets)).astype(np.int64), rows)
            if sum(map(len, token_buckets)):
                rows = {name: np.concatenate([own[name] for own in token_rows]) for name in token_rows[0]}
                yield out(1, np.concatenate(token_buckets), rows)

        for batch in batches:
            ids, text_hashes = (batch.column(c).to_numpy() for c in ("id", "text_hash"))
            line_rows, token_rows, token_buckets, size = [], [], [], 0
            for first, offsets, data in blocks(batch.column("text")):
                found = Lines(offsets, data, counts.value, None if tokens is None else tokens.value)
                text = found.text + first
                if not len(text):
                    continue
                key = class_key(found.parity[:, 0], found.check)
                if tokens is None:
                    rows = np.empty(len(text), dtype=LINE)
                    rows["key"], rows["other"], rows["id"] = key, found.other, ids[text]
                    rows["text_hash"], rows["number"] = text_hashes[text], found.number
                    line_rows.append(rows)
                keep = prefix(found.n, percent)
                # Of equal sets in a block the first is enough.
                order = np.lexsort((found.number, ids[text], key))
                keep[order[np.r_[False, key[order][1:] == key[order][:-1]]]] = 0
                place = np.arange(len(found.tokens)) - np.repeat(found.first, found.n)
                at = np.flatnonzero(place < np.repeat(keep, found.n))
                line = np.repeat(np.arange(len(found.n)), found.n)[at]
                spread = mix(found.tokens[at])
                if tokens is not None:
                    good = in_filter(tokens.value, spread)
                    at, line, spread = at[good], line[good], spread[good]
                rows = {"token": spread >> np.uint64(32), "place": place[at], "n": found.n[line], "number": found.number[line],
                        "check": found.check[line], "id": ids[text[line]], "tag": text_hashes[text[line]] & 0xFFFFFFFF}
                rows = {name: values.astype(TOKEN[name]) for name, values in rows.items()}
                rows["sketch"] = found.parity[line]
                token_rows.append(rows)
                token_buckets.append((spread & np.uint64(0xFFFFFFFF)).astype(np.int64) % buckets)
                size += len(data)
                if size >= FLUSH_BYTES:
                    yield from flushed(line_rows, token_rows, token_buckets)
                    line_rows, token_rows, token_buckets, size = [], [], [], 0
            yield from flushed(line_rows, token_rows, token_buckets)

    sent = docs.mapInArrow(send, "kind int, bucket int, blob binary")
    return sent.repartition(buckets, "kind", "bucket").sortWithinPartitions("kind", "bucket")


def class_key(parity, check):
    """The key of a set of tokens, from its parity sketch and check sum."""
    return mix(parity * _K[2] + check.astype(np.uint64) * _K[3])


def later_copies(rows):
    """Of lines of a bucket those that have an equal one before them."""
    rows = rows[np.lexsort((rows["text_hash"], rows["number"], rows["id"], rows["other"], rows["key"]))]
    start = np.r_[True, (rows["key"][1:] != rows["key"][:-1]) | (rows["other"][1:] != rows["other"][:-1])]
    first = np.flatnonzero(start)[np.cumsum(start) - 1]
    # The same place of the same text twice is a repeated row, not a later line.
    return rows[(rows["id"] != rows["id"][first]) | (rows["number"] != rows["number"][first]) | (rows["text_hash"] != rows["text_hash"][first])]


def candidates(rows, percent, most, wanted):
    """Pairs ``(x, y, more)`` of row numbers: x before y, at a shared prefix token, that no filter rules out.

    A y gets ``most`` of them at a token, those of smaller sets first; ``more`` says that it has
    reached that number. ``rows`` has an array for each field.
    """
    # Rows by token, without those that are alone with theirs.
    packed = np.sort((rows["token"].astype(np.uint64) << np.uint64(32)) | np.arange(len(rows["token"]), dtype=np.uint64))
    token = packed >> np.uint64(32)
    same = token[1:] == token[:-1]
    alone = ~(np.r_[False, same] | np.r_[same, False])
    order, token = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)[~alone], token[~alone]
    if not len(order):
        return order, order, np.zeros(0, dtype=bool)
    # Each set once, at its first place.
    group = np.cumsum(np.r_[False, token[1:] != token[:-1]]).astype(np.uint64)
    content = mix(rows["sketch"][order, 0] + rows["check"][order].astype(np.uint64) * _K[3])
    by = np.argsort((group << np.uint64(32)) | (content >> np.uint64(32)))
    order, group, content = order[by], group[by], content[by]
    first = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (content[1:] != content[:-1])])
    id, number = rows["id"][order], rows["number"][order].astype(np.int64)
    sizes = np.diff(np.r_[first, len(order)])
    least = np.repeat(np.minimum.reduceat(id, first), sizes)
    number = np.where(id == least, number, 1 << 40)
    here = (number == np.repeat(np.minimum.reduceat(number, first), sizes)) & (id == least)
    # Several rows of one place may be left, from a repeated row; the first will do.
    at = np.flatnonzero(here)
    at = at[np.r_[True, np.repeat(np.arange(len(first)), sizes)[at][1:] != np.repeat(np.arange(len(first)), sizes)[at][:-1]]]
    order, group = order[at], group[at]
    same = group[1:] == group[:-1]
    several = np.r_[False, same] | np.r_[same, False]
    order, group = order[several], group[several]
    by = np.lexsort((rows["number"][order], rows["id"][order], group))
    order, token = order[by], group[by]
    if not len(order):
        return order, order, np.zeros(0, dtype=bool)
    # Rows of a token by size and place; ``rank`` tells which of two is before.
    token, n, place = token.astype(np.int64), rows["n"][order].astype(np.int64), rows["place"][order].astype(np.int64)
    rank = np.lexsort((place, n, token))
    order, token, n, place = order[rank], token[rank], n[rank], place[rank]
    ys = np.arange(len(order))
    if wanted is not None:
        ys = ys[in_filter(wanted, place_key(rows["id"][order], rows["tag"][order], rows["number"][order]))]
    sketch, wide = rows["sketch"][order], width_of(n)
    fold = np.bitwise_xor.reduce(sketch, axis=1)  # as if all sets were narrow
    key = (token << 32) | n
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    kind = np.cumsum(np.r_[False, key[1:] != key[:-1]])
    key, cell = key[first], (kind << 32) | place
    # The kinds (token and size) that may hold a match of each y.
    low = np.searchsorted(key, (token[ys] << 32) | -(-percent * n[ys] // 100))
    high = np.searchsorted(key, (token[ys] << 32) | (100 * n[ys] // percent), side="right")
    xs, found, more = [], [], []
    for part in runs_of(high - low, PAIRS):
        y, count = ys[part], (high - low)[part]
        who = np.repeat(np.arange(len(y)), count)
        other = np.repeat(low[part] - np.cumsum(count) + count, count) + np.arange(count.sum())
        a, b, j = n[first[other]], n[y][who], place[y][who]
        least = needed(a, b, percent)
        # Where the token stands in x, for so many tokens to be shared from there on and before.
        begin = np.searchsorted(cell, (other << 32) | np.maximum(j - (b - least), 0))
        end = np.searchsorted(cell, (other << 32) | (j + (a - least)), side="right")
        some = end > begin
        x, hit, full = first_matches(y, who[some], begin[some], (end - begin)[some], (a + b - 2 * least)[some], rank, fold, sketch, wide, most)
        xs.append(order[x])
        found.append(order[hit])
        more.append(full)
    if not found:
        return order[:0], order[:0], np.zeros(0, bool)
    return np.concatenate(xs), np.concatenate(found), np.concatenate(more)


def runs_of(sizes, most):
    """Slices of neighbours whose sizes add up to ``most``, or one more at the most."""
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(ends, np.arange(most, ends[-1], most)) + 1 if len(ends) else []
    edges = np.unique(np.r_[0, cuts, len(sizes)]).astype(np.int64).tolist()
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def first_matches(y, who, begin, size, slack, rank, fold, sketch, wide, most):
    """The first ``most`` rows for each of ``y`` that are before it and that no sketch rules out: ``(x, y, more)``.

    Range ``i`` of ``size[i]`` rows from ``begin[i]`` on is tried for ``y[who[i]]``, in which ``slack[i]``
    tokens may differ; a y that has its matches tries no more.
    """
    ahead = np.cumsum(size) - size
    total = np.bincount(who, weights=size, minlength=len(y)).astype(np.int64)
    start = np.cumsum(total) - total
    done, given = np.zeros(len(y), dtype=np.int64), np.zeros(len(y), dtype=np.int64)
    xs, found, tries, left = [], [], TRIES, np.flatnonzero(total)
    while len(left):
        for part in runs_of(np.minimum(tries, (total - done)[left]), PAIRS):
            own = left[part]
            count = np.minimum(tries, (total - done)[own])
            of = np.repeat(own, count)
            at = np.repeat((start + done)[own] - np.cumsum(count) + count, count) + np.arange(count.sum())
            done[own] += count
            where = np.searchsorted(ahead, at, side="right") - 1
            x = begin[where] + at - ahead[where]
            fit = np.flatnonzero(rank[x] < rank[y[of]])
            x, of, most_apart = x[fit], of[fit], slack[where[fit]]
            fit = np.bitwise_count(fold[x] ^ fold[y[of]]) <= most_apart
            x, of, most_apart = x[fit], of[fit], most_apart[fit]
            both = np.flatnonzero((wide[x] > 1) & (wide[y[of]] > 1))
            if len(both):
                i, k = x[both], y[of[both]]
                fit = np.ones(len(x), dtype=bool)
                fit[both] = apart(sketch[i], sketch[k], wide[i], wide[k]) <= most_apart[both]
                x, of = x[fit], of[fit]
            if len(of):
                new = np.r_[True, of[1:] != of[:-1]]
                nth = np.arange(len(of)) - np.flatnonzero(new)[np.cumsum(new) - 1]
                fit = given[of] + nth < most
                x, of = x[fit], of[fit]
                given += np.bincount(of, minlength=len(y))
                xs.append(x)
                found.append(of)
        left = left[(done[left] < total[left]) & (given[left] < most)]
        tries *= 4
    if not found:
        return y[:0], y[:0], np.zeros(0, bool)
    of = np.concatenate(found)
    return np.concatenate(xs), y[of], given[of] >= most


def in_filter(bits, keys):
    cell = keys & np.uint64(FILTER_BITS - 1)
    return (bits[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A bit for each key of a table, in a filter of fixed size; other keys may share a bit."""
    cell = F.pmod(F.col(column), F.lit(FILTER_BITS))
    parts = (keys.select(F.floor(cell / BITMAP).alias("part"), (cell % BITMAP).alias("bit"))
             .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in parts:  # 4,096 rows of 4 KB at most
        at = row["part"] * (BITMAP // 8)
        out[at:at + BITMAP // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


FOUND = "kind int, x bigint, y bigint, x_id bigint, id bigint, text_hash bigint, number int, more boolean"


def _meet(percent, most, wanted):
    def work(kind, blobs):
        import pyarrow as pa

        names = [f.split()[0] for f in FOUND.split(", ")]
        if kind == 0:
            rows = later_copies(_unpack(blobs, LINE))
            zero = np.zeros(len(rows), dtype=np.int64)
            columns = [zero, zero, zero, rows["id"], rows["text_hash"], rows["number"], zero.astype(bool)]
        else:
            rows = _unpack_tokens(blobs)
            x, y, more = candidates(rows, percent, most, None if wanted is None else wanted.value)
            key_x, key_y = (place_key(rows["id"][z], rows["tag"][z], rows["number"][z]).view(np.int64) for z in (x, y))
            columns = [key_x, key_y, rows["id"][x], rows["id"][y], np.zeros(len(y), np.int64), rows["number"][y], more]
        columns = [pa.array(np.ascontiguousarray(c)) for c in columns]
        columns[5] = columns[5].cast(pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(columns[0]), pa.int32()), *columns], names=names)

    def meet(batches):
        held, blobs = None, []
        for batch in batches:
            for kind, bucket, blob in zip(*(batch.column(c).to_pylist() for c in ("kind", "bucket", "blob"))):
                if held not in (None, (kind, bucket)):
                    yield work(held[0], blobs)
                    blobs = []
                held = (kind, bucket)
                blobs.append(blob)
        if held is not None:
            yield work(held[0], blobs)
    return meet


def _sets(docs, wanted):
    """Sets of words of the lines whose place the filter holds: ``(key, text_hash, words)``."""
    def pick(batches):
        import pyarrow as pa

        for batch in batches:
            ids, text_hashes = (batch.column(c).to_numpy() for c in ("id", "text_hash"))
            for first, offsets, data in blocks(batch.column("text")):
                text, number, begin = ends_of_lines(offsets, data)
                end = np.append(begin[1:], len(data))
                text = text + first
                key = place_key(ids[text], text_hashes[text] & 0xFFFFFFFF, number)
                good = np.flatnonzero(in_filter(wanted.value, key))
                if not len(good):
                    continue
                # The bytes of these lines only, one behind the other.
                edges = np.append(0, np.cumsum(end[good] - begin[good]))
                own = np.concatenate([data[a:b] for a, b in zip(begin[good].tolist(), end[good].tolist())])
                hashes, starts, _ = word_hashes(edges, own)
                places = np.searchsorted(starts, edges)
                some = places[1:] > places[:-1]
                words = [np.unique(hashes[a:b]).tobytes() for a, b in zip(places[:-1][some].tolist(), places[1:][some].tolist())]
                good = good[some]
                if len(good):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[good].view(np.int64)), pa.array(text_hashes[text[good]]), pa.array(words, pa.binary())],
                        names=["key", "text_hash", "words"])

    # Only a repeated row stands in the same place.
    return docs.mapInArrow(pick, "key bigint, text_hash bigint, words binary").dropDuplicates(["key"])


def _prefix_tokens(counts, percent):
    """Task function: the tokens that the sets of the rows are looked up by, mixed."""
    def tokens(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            for words in batch.column("words").to_pylist():
                word = np.unique(np.frombuffer(words, dtype=np.uint64) >> np.uint64(16))
                rarity = counts.value[(word >> np.uint64(48 - CELL_BITS)).astype(np.int64)]
                own = np.sort((rarity << np.uint64(40)) | (word >> np.uint64(8))) & _LOW[1]
                found.append(mix(own[:int(prefix(np.array([len(own)]), percent)[0])]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["token"])
    return tokens


def _settle(percent):
    def settle(batches):
        import pyarrow as pa

        for batch in batches:
            yes = []
            for a, b in zip(batch.column("x_words").to_pylist(), batch.column("y_words").to_pylist()):
                both = np.frombuffer(a + b, dtype=np.uint64).copy()
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                yes.append(100 * shared >= percent * (len(both) - shared))
            yes = pa.array(yes, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(yes) for c in ("y", "id", "text_hash", "number")],
                                             names=["y", "id", "text_hash", "number"])
    return settle


def matched_lines(df: DataFrame, id="doc_id", text="text", percent=80) -> DataFrame:
    """Places ``(id, text_hash, number)`` of the lines that go; see ``dedup_lines``."""
    spark = df.sparkSession
    docs = df.select(F.coalesce(F.col(id).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("text_hash"),
                     F.col(text).alias("text")).where("text IS NOT NULL")
    counts, size = token_counts(docs)
    counts = Shared(spark, counts)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    gone, most, wanted, tokens = [], FIRST, None, None
    while True:
        met = _exchange(docs, counts, buckets, percent, tokens).mapInArrow(_meet(percent, most, wanted), FOUND)
        met = materialise(met, "lines")
        if wanted is None:
            gone.append(met.where("kind = 0").select("id", "text_hash", "number"))
        pairs = met.where("kind = 1").groupBy("x", "y").agg(
            F.min("x_id").alias("x_id"), F.min("id").alias("id"), F.min("number").alias("number"), F.max("more").alias("more"))
        pairs = materialise(pairs, "pairs")
        keys = pairs.select(F.col("x").alias("key")).union(pairs.select(F.col("y").alias("key"))).distinct()
        asked = Shared(spark, key_filter(keys, "key"))
        holders = pairs.select(F.col("x_id").alias("id")).union(pairs.select("id"))
        sets = materialise(_sets(possibly_in(docs, F.col("id"), holders, "id"), asked), "sets")
        x = sets.select(F.col("key").alias("x"), F.col("words").alias("x_words"))
        y = sets.select(F.col("key").alias("y"), F.col("words").alias("y_words"), "text_hash")
        settled = (pairs.join(y.hint("merge"), "y").join(x.hint("merge"), "x").select("y", "id", "text_hash", "number", "x_words", "y_words")
                   .mapInArrow(_settle(percent), "y bigint, id bigint, text_hash bigint, number int"))
        settled = materialise(settled.distinct(), "settled")
        gone.append(settled.select("id", "text_hash", "number"))
        # Sets that had more candidates than were tried, and no match among those, go on.
        left = pairs.where("more").select("y").distinct().join(settled.hint("merge"), "y", "left_anti")
        left = materialise(left.join(y.hint("merge"), "y").select("y", F.col("y_words").alias("words")), "open")
        if left.isEmpty():
            break
        wanted = Shared(spark, key_filter(left, "y"))
        looked_up = left.select("words").mapInArrow(_prefix_tokens(counts, percent), "token bigint").distinct()
        tokens = Shared(spark, key_filter(looked_up, "token"))
        most *= WIDEN
    out = gone[0]
    for more in gone[1:]:
        out = out.union(more)
    return out.distinct()


def dedup_lines(df: DataFrame, id="doc_id", text="text", percent=80) -> DataFrame:
    """Take out of every text the lines that match an earlier one; adds ``n_lines`` and ``n_removed``.

    Lines end at a line feed. Two lines match when the Jaccard similarity of their
    sets of words (as in ``words``) reaches ``percent``; lines without words match
    nothing. A line goes if any line before it matches, by id and then by its place
    in the text; null ids come last, and rows that repeat id and text are treated
    alike, neither before the other. ``id`` is an integer column. What stays is
    joined by line feeds; a text that loses all lines becomes empty, a null text
    stays null with 0 lines. Other columns stay; those named like the new ones
    become ``<name>_in``. An empty table gives no rows.
    """
    added = ["n_lines", "n_removed"]
    if {id.lower(), text.lower()} & set(added):
        raise ValueError("the id and text columns may not be named like the new ones")
    df = free_of(df, *added)
    g_id, g_hash, g_numbers = names_for(df, "gone_id", "gone_hash", "gone_numbers")
    gone = (matched_lines(df, id, text, percent).groupBy(F.col("id").alias(g_id), F.col("text_hash").alias(g_hash))
            .agg(F.sort_array(F.collect_list("number")).alias(g_numbers)))
    same = (F.coalesce(F.col(id).cast("bigint"), F.lit(LAST_ID)) == F.col(g_id)) & (F.xxhash64(text) == F.col(g_hash))
    joined = df.join(gone, same, "left")
    lines = F.split(F.col(text), "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(g_numbers))
    stays = let(lines, lambda own: F.array_join(F.transform(places, lambda i: F.get(own, i)), "\n"))
    return (joined.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("bigint"))
            .withColumn("n_removed", F.coalesce(F.size(g_numbers), F.lit(0)).cast("bigint"))
            .withColumn(text, F.when(F.col(g_numbers).isNull(), F.col(text)).otherwise(stays))
            .drop(g_id, g_hash, g_numbers))
