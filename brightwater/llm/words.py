"""Words, lines and n-grams of whole Arrow batches as numpy arrays, without a Python string per word.

A word is hashed to 64 bits from blocks of eight bytes, each sent through a non-linear mix that is another one at
each place, so equal words have equal hashes everywhere, on every executor, and no family of words collides by
construction. Arrays are made half a megabyte of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
#: ASCII that is neither a letter nor a digit.
NOT_ALNUM = np.array([not (c >= 0x80 or chr(c).isalnum()) for c in range(256)])
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32
_P, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes of text that arrays of eight bytes a character are made of at once.
_BLOCK = 1 << 19
#: The first 0 to 8 bytes of a little-endian block.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the input moves every bit of the output."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class Segments:
    """Maximal runs of bytes that are no separators, within documents: words or lines.

    doc: the place in the batch; start, end: bytes; data, bounds: the batch's bytes and where
    each document starts.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, separators: np.ndarray | None = None, inside: np.ndarray | None = None):
        self.data, self.bounds = data, bounds
        inside = ~separators[data] if inside is None else inside
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        opens = bounds[:-1][bounds[:-1] < len(data)]
        first[opens] = inside[opens]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        closes = opens[opens > 0] - 1
        last[closes] = inside[closes]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(bounds, self.start, "right") - 1

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.bounds) - 1)

    def hashes(self) -> np.ndarray:
        out = np.zeros(len(self.start), np.uint64)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        blocks = (self.end - self.start + 7) >> 3
        upto = np.concatenate([[0], np.cumsum(blocks)])
        i = 0
        while i < len(self.start):
            j = max(i + 1, int(np.searchsorted(upto, upto[i] + (_BLOCK >> 3), "right")) - 1)
            first = upto[i:j] - upto[i]
            place = np.arange(upto[j] - upto[i]) - np.repeat(first, blocks[i:j])
            left = np.repeat(self.end[i:j] - self.start[i:j], blocks[i:j]) - 8 * place
            block = eights[np.repeat(self.start[i:j], blocks[i:j]) + 8 * place] & _FIRST[np.minimum(left, 8)]
            mixed = mix(block ^ mix(place.astype(np.uint64) * _P + _M1))
            out[i:j] = mix(np.add.reduceat(mixed, first) + (self.end[i:j] - self.start[i:j]).astype(np.uint64) * _M2)
            i = j
        return out


def batches(column: pa.Array, block: int = _BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, bounds) for runs of rows of about ``block`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def count_in(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of a document's bytes are marked."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def ngrams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, hash) of each run of n words within a document."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = len(hashes) - n + 1
    h = hashes[:last].copy()
    for k in range(1, n):
        h = mix(h * _P + hashes[k:last + k])
    at = np.flatnonzero(doc[:last] == doc[n - 1:])
    return at, h[at]


def within(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within the same document of the batch."""
    return mix(hashes ^ mix(doc.astype(np.uint64) + _P))


def equal_runs(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether run i of ``a`` has the very bytes of run i of ``b``."""
    same = (a_end - a_start) == (b_end - b_start)
    at = np.flatnonzero(same)
    lengths = (a_end - a_start)[at]
    blocks = (lengths + 7) >> 3
    if not blocks.sum():
        return same
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    place = 8 * (np.arange(int(blocks.sum())) - np.repeat(first, blocks))
    mask = _FIRST[np.minimum(np.repeat(lengths, blocks) - place, 8)]
    one, two = (np.ndarray(len(x) + 1, "<u8", np.concatenate([x, np.zeros(8, np.uint8)]), strides=(1,)) for x in (a, b))
    differ = (one[np.repeat(a_start[at], blocks) + place] ^ two[np.repeat(b_start[at], blocks) + place]) & mask != 0
    same[at[np.repeat(np.arange(len(at)), blocks)[differ]]] = False
    return same
