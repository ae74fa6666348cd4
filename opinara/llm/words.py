"""Words of whole texts as 64-bit hashes, found for many texts at once.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. The
hash of a word is a polynomial over random byte values, then mixed. Such polynomials
have different long words of equal hash (those of Thue and Morse, from some 500 bytes
on, whatever the base), so words over ``LONG`` bytes have a cryptographic hash. Bytes are
handled in blocks of whole texts of about ``BLOCK`` bytes; a longer text is a
block of its own.
"""

import ctypes
import hashlib

import numpy as np

BLOCK = 2 << 20
RUN = 1 << 15
LONG = 64
MASK = (1 << 64) - 1


def stream(seed, n):
    """``n`` fixed odd 64-bit values."""
    out, x = [], seed
    for _ in range(n):
        x = (x + 0x9E3779B97F4A7C15) & MASK
        z = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB & MASK
        out.append((z ^ (z >> 31)) | 1)
    return np.array(out, dtype=np.uint64)


SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
VALUE = stream(1, 256)
VALUE[65:91] = VALUE[97:123]
VALUE[SPACE] = 0
BASE = int(stream(2, 1)[0])
INVERSE = pow(BASE, -1, 1 << 64)
_tables = {}


def _powers(base, n):
    """At least ``n`` powers of an odd 64-bit number."""
    table = _tables.get(base)
    if table is None or len(table) < n:
        table = _tables[base] = np.cumprod(np.r_[np.uint64(1), np.full(max(n, BLOCK + BLOCK // 8), base, dtype=np.uint64)], dtype=np.uint64)
    return table


class Hashes:
    """Prefix polynomial hashes of a byte array: the hash of any substring in constant time."""

    def __init__(self, data, values, base):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        terms = np.take(values, data)
        terms *= _powers(base, len(data))[:len(data)]
        np.cumsum(terms, out=self.sums[1:])
        self.shift = _powers(pow(base, -1, 1 << 64), len(data) + 1)

    def of(self, start, end):
        return (self.sums[end] - self.sums[start]) * self.shift[start]


def mix(x):
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(array):
    """Yield ``(first, offsets, data)`` for runs of texts of an Arrow string or binary array.

    ``offsets`` start at 0; a null text has no bytes.
    """
    import pyarrow as pa

    array = array.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    _, places, values = array.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(array):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK, side="right")) - 1
        last = min(max(last, first + 1), len(array))
        own = offsets[first:last + 1]
        yield first, own - own[0], data[own[0]:own[-1]]
        first = last
    free()


def free():
    """Give memory that this worker no longer uses back to its machine."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def word_places(offsets, data, stops=()):
    """Words of a block: ``(start, end)``. Words end at text ends and at the places ``stops`` begin."""
    inside = (data != 32) & (data - np.uint8(9) > 4)  # bytes wrap around, so that those below 9 are inside
    first, last = inside.copy(), inside.copy()
    np.greater(inside[1:], inside[:-1], out=first[1:])
    np.greater(inside[:-1], inside[1:], out=last[:-1])
    for cut in (np.asarray(offsets), np.asarray(stops, dtype=np.int64)):
        begin, end = cut[cut < len(data)], cut[cut > 0] - 1
        first[begin], last[end] = inside[begin], inside[end]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def sums_of_words(data, starts):
    """The polynomial of each word, from its first byte on; the bytes of a gap have the value 0.

    A run of words at a time, so that its terms stay in a processor's own cache.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    edges = np.searchsorted(starts, np.arange(0, len(data), RUN))
    edges = np.append(edges[np.r_[True, edges[1:] != edges[:-1]]], len(starts)).tolist()
    terms = np.empty(2 * RUN, dtype=np.uint64)
    for a, b in zip(edges[:-1], edges[1:]):
        if a == b:
            continue
        low, high = int(starts[a]), int(starts[b]) if b < len(starts) else len(data)
        if high - low > len(terms):
            terms = np.empty(high - low, dtype=np.uint64)
        own, at = terms[:high - low], starts[a:b] - low
        np.take(VALUE, data[low:high], out=own, mode="clip")
        own *= _powers(BASE, len(own))[:len(own)]
        out[a:b] = np.add.reduceat(own, at) * _powers(INVERSE, len(own))[at]
    return out


def word_hashes(offsets, data, stops=()):
    """Words of a block: ``(hash, start, end)``. Words end at text ends and at the places ``stops`` begin."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    starts, ends = word_places(offsets, data, stops)
    if not len(starts):
        return starts.astype(np.uint64), starts, ends
    hashes = mix(sums_of_words(data, starts))
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        word = data[starts[i]:ends[i]].tobytes().lower()
        hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return hashes, starts, ends


def per_text(offsets, starts):
    """Index of the first word of each text, and one past the last."""
    return np.searchsorted(starts, offsets)


FACTORS = stream(3, 64)


def shingles(words, k):
    """Sorted distinct hashes of the ``k``-word shingles of one text; all its words as one if fewer."""
    if not len(words):
        return words
    m = min(k, len(words))
    total = np.zeros(len(words) - m + 1, dtype=np.uint64) + mix(np.array([m], dtype=np.uint64))
    for i in range(m):
        total += words[i:len(words) - m + 1 + i] * FACTORS[i]
    total = np.sort(mix(total))
    return total[np.r_[True, total[1:] != total[:-1]]]


def set_key(hashes):
    """128-bit digest of a sorted set of hashes."""
    import hashlib

    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
