"""Vectorised word and window hashing over Arrow batches of texts.

Words are maximal runs of bytes other than ``\\x20\\x09-\\x0D``, each with a keyed 64-bit hash.
Hashes of word runs are 64-bit polynomials over the words' hashes, taken from prefix sums and
mixed afterwards, so any window costs a constant number of array operations.  Polynomials modulo
a power of two have runs that collide by construction from 1,024 words on: windows are at most
``LONGEST`` words.  A slice of about ``SLICE`` bytes is worked on at once: memory depends on the
longest text, not on the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array

SLICE = 1 << 20
U = np.uint64
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective avalanche of 64-bit integers (the SplitMix64 finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Key of the words' hashes, 16 characters.
WORD_KEY = "words of a text "
#: Words of a run that may be compared by hash.
LONGEST = 512


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (self._run(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base: int, n: int) -> np.ndarray:
        out = np.full(n, base & _MASK, dtype=U)
        out[0] = 1
        return np.multiply.accumulate(out)


_FIRST = _Powers(0xD6E8FEB86659FD93)
_SECOND = _Powers(0xA0761D6478BD642F)


def _prefix(values: np.ndarray, powers: _Powers) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * powers.upto(len(values))[0], out=out[1:])
    return out


class Hasher:
    """Hashes of word runs ``[i, j)`` of a sequence of word hashes."""

    def __init__(self, words: np.ndarray, second: bool = False) -> None:
        self.powers = _SECOND if second else _FIRST
        self.sums = _prefix(words, self.powers)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(start) == 0:
            return np.zeros(0, dtype=U)
        down = self.powers.upto(len(self.sums))[1]
        return mix((self.sums[end] - self.sums[start]) * down[start] + (end - start).astype(U))

    def windows(self, size: int) -> np.ndarray:
        """Hashes of ``[i, i + size)`` for every i, crossing texts as well."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, dtype=U)
        down = self.powers.upto(len(self.sums))[1]
        return mix((self.sums[size:] - self.sums[:n]) * down[:n] + U(size))


@dataclass
class Slice:
    """Some whole texts of a batch: their bytes and words."""

    first: int                # index of the first text in its batch
    bytes: np.ndarray         # uint8
    offsets: np.ndarray       # len(texts) + 1, into bytes
    starts: np.ndarray        # of each word, into bytes
    ends: np.ndarray
    hashes: np.ndarray        # uint64, of each word
    doc: np.ndarray           # text of each word, counted from 0
    bounds: np.ndarray        # len(texts) + 1, into the words

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.bytes[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def whole(self, size: int) -> np.ndarray:
        """Starts of the windows of ``size`` words that lie in one text."""
        n = len(self.doc) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.doc[:n] == self.doc[size - 1:])


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keyed SipHash of each word's bytes, once per distinct word of a chunk.  A polynomial over the
    bytes would do for chance, but has words that collide by construction.  Chunks are whole words, so
    that a text of any length needs little besides its words."""
    out = np.empty(len(starts), dtype=U)
    at = 0
    while at < len(starts):
        low = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, low + 2 * SLICE, side="right")))
        part, offsets = data[low:ends[upto - 1]], np.zeros(upto - at + 1, dtype=np.int32)
        np.cumsum(ends[at:upto] - starts[at:upto], out=offsets[1:])
        words = pa.StringArray.from_buffers(upto - at, pa.py_buffer(offsets), pa.py_buffer(part[~SPACE[part]])).dictionary_encode()
        distinct = hash_array(words.dictionary.to_numpy(zero_copy_only=False), hash_key=WORD_KEY, categorize=False)
        out[at:upto] = distinct[words.indices.to_numpy(zero_copy_only=False)]
        at = upto
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, null as the empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array) -> Iterator[Slice]:
    """The texts of a column in slices of about SLICE bytes."""
    if len(column) == 0:
        return
    data, offsets = text_buffers(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1)
        yield _slice(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def _slice(first: int, data: np.ndarray, offsets: np.ndarray) -> Slice:
    solid = np.zeros(len(data) + 2, dtype=bool)
    solid[1:-1] = ~SPACE[data]
    begins, stops = solid[1:-1] & ~solid[:-2], solid[1:-1] & ~solid[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = solid[1:-1][inner]
    stops[inner - 1] = solid[1:-1][inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    bounds = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Slice(first, data, offsets, starts, ends, _word_hashes(data, starts, ends), doc, bounds)


def covered(starts: np.ndarray, sizes: np.ndarray | int, n: int) -> np.ndarray:
    """Flags of the n positions that lie in a span."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + sizes, -1)
    return np.cumsum(edge[:-1]) > 0
