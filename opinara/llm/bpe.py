"""Byte-level BPE encoding and decoding with the merges of a rank file (op 9).

The bytes of a piece are mapped to Latin-1 letters, and an Aho-Corasick automaton
finds every token in it. Encoding takes the longest token at each place and goes
back to a shorter one, or to the token before, when two neighbours could not stand
side by side after the merges. Whether they could is settled by taking the two
apart along their own merges, and remembered. A place that has failed is never
tried again, so the work is linear in the piece.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, free_of, kept_apart, names_for
from .words import free

MEMO_PAIRS = 300_000
MEMO_PIECES = 200_000
ROWS_AT_ONCE = 256
MEMO_LENGTH = 64

ENCODED = "n_tokens bigint, ids binary, decoded binary"
DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(piece: bytes, ranks, below: float) -> list[bytes]:
    """Parts of ``piece`` after all merges of a rank under ``below``, lowest first; for building tables."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1)]
        rank, i = min(found)
        if rank >= below:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


@lru_cache(maxsize=4)
def halves(path: str) -> dict[bytes, tuple[bytes, bytes]]:
    """The two parts whose merge makes each token; tokens that no merge makes are left out."""
    ranks = read_ranks(path)
    out = {}
    for token, rank in ranks.items():
        if len(token) > 1:
            parts = merged(token, ranks, rank)
            if len(parts) == 2:
                out[token] = (parts[0], parts[1])
    return out


class Coder:
    """Encodes and decodes texts. ``ranks``: bytes to id; ``split``: the halves of each merged token."""

    def __init__(self, ranks, split, pattern):
        import ahocorasick
        import regex

        self.ranks, self.split = ranks, split
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}")
        self.bytes_of = dict(map(reversed, ranks.items()))
        self.pieces = regex.compile(pattern).findall
        self.tokens = ahocorasick.Automaton()
        self.shorter = {}  # the next shorter token that begins a token
        for token in ranks:
            if len(token) == 1 or token in split:
                self.tokens.add_word(token.decode("latin-1"), (len(token) - 1, token))
                heads = (token[:k] for k in range(len(token) - 1, 0, -1))
                self.shorter[token] = next((h for h in heads if h in split or len(h) == 1), None)
        self.tokens.make_automaton()
        self.pairs = {}
        self.memo = {}

    def adjacent(self, left: bytes, right: bytes) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._adjacent(left, right)
        return known

    def _adjacent(self, left, right):
        # Undo the later merge of the two inner edges step by step. If the parts that
        # then touch merge before that step, they would not have stayed apart.
        ranks, split = self.ranks, self.split
        limit = float("inf")
        while True:
            joint = ranks.get(left + right)
            if joint is not None and joint < limit:
                return False
            undo_left = left in split and (right not in split or ranks[left] > ranks[right])
            if undo_left:
                # The left merge comes first among equals, as merges run from the left.
                limit = ranks[left]
                left = split[left][1]
            elif right in split:
                limit = ranks[right] + 1
                right = split[right][0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [None] * n
        for end, (reach, token) in self.tokens.iter(piece.decode("latin-1")):
            longest[end - reach] = token  # of the tokens from one place the longest ends last
        pairs, shorter, out, place, left = self.pairs, self.shorter, [], 0, None
        failed, untried = bytearray(n + 1), longest[:]
        token = longest[0]
        while place < n:
            while token is not None:
                if not failed[place + len(token)]:
                    fits = left is None or pairs.get((left, token))
                    if fits is None:
                        fits = self.adjacent(left, token)
                    if fits:
                        break
                token = shorter.get(token)
            if token is None:
                failed[place] = 1
                place -= len(out.pop())
                left = out[-1] if out else None
                token = untried[place]
            else:
                untried[place] = shorter.get(token)
                out.append(token)
                place += len(token)
                left = token
                token = longest[place] if place < n else None
        return [self.ranks[token] for token in out]

    def packed(self, piece: str) -> bytes:
        """Ids of a piece as little-endian 32-bit integers."""
        ids = self.memo.get(piece)
        if ids is None:
            ids = np.array(self.encode_piece(piece.encode()), dtype="<u4").tobytes()
            if len(piece) <= MEMO_LENGTH:
                if len(self.memo) >= MEMO_PIECES:
                    self.memo.clear()
                self.memo[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        memo, out = self.memo.get, []
        packed = self.packed
        for piece in self.pieces(text):
            out.append(memo(piece) or packed(piece))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _codec(spark, path, pattern):
    return spark.sparkContext.broadcast((read_ranks(path), halves(path), pattern))


_coders = kept_apart({})


def _coder(shared):
    key = shared.id if hasattr(shared, "id") else id(shared)
    if key not in _coders:
        forget()
        _coders[key] = Coder(*shared.value)
    return _coders[key]


def encode_documents(df: DataFrame, path: str, pattern: str, text="text", digests=False) -> DataFrame:
    """Add ``n_tokens``, ``ids`` and ``decoded`` (binary), or with ``digests`` their SHA-256 in hex.

    ``path`` is a rank file, its size that of the vocabulary; it is read on the
    driver and shared with the tasks. Each match of ``pattern`` is encoded by
    itself. A null or empty text has no ids; a text of any length is encoded whole;
    repeated rows each keep their row; other columns stay, and those with the
    names of the new ones become ``<name>_in``. Needs no shuffle.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids", "decoded"]
    kind = dict(zip(df.columns, [f.dataType.simpleString() for f in df.schema.fields]))[text]
    if kind not in ("string",):
        df = df.withColumn(text, F.col(text).cast("string"))
    if text.lower() in added:
        raise ValueError(f"the text column may not be called {text}")
    df = free_of(df, *added)
    import pyarrow as pa

    shared = _codec(df.sparkSession, path, pattern)

    def piece(coder, texts):
        kind = pa.string() if digests else pa.binary()
        ids = [coder.encode(value) if value else b"" for value in texts.to_pylist()]
        columns = [ids, map(coder.decode, ids)]
        if digests:
            columns = [[hashlib.sha256(x).hexdigest() for x in column] for column in columns]
        lengths = pa.array([len(x) // 4 for x in ids], pa.int64())
        return pa.StructArray.from_arrays([lengths, *(pa.array(list(c), kind) for c in columns)], names=added)

    @F.arrow_udf(DIGESTS if digests else ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # A few rows go back at a time, so neither side holds the ids and bytes of a whole batch.
        coder = _coder(shared)
        for texts in batches:
            for k in range(0, len(texts), ROWS_AT_ONCE):
                yield piece(coder, texts.slice(k, ROWS_AT_ONCE))
            free()

    (coded,) = names_for(df, "coded")
    return df.withColumn(coded, run(F.col(text))).select(*df.columns, *[F.col(coded)[c].alias(c) for c in added])
