"""Words of Arrow text columns as numpy arrays: where they stand, their document, their 64-bit hash.

Texts stay UTF-8 bytes. A byte table says which bytes belong to words and a second one lower-cases A-Z, so one pass over a
batch finds all words; no Python object is made per word. Every byte of a multi-byte character is at least 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z: digits, letters, everything beyond ASCII.
ALNUM = np.ones(256, bool)
ALNUM[:0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False

#: Bytes of ``[^\x20\x09-\x0D]``.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[0x20] = NOT_BLANK[0x09:0x0E] = False

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes hashed at a time; longer stretches are cut between words.
STRETCH = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each value begins (one offset more than values); null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, size: int = 2 * STRETCH) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


def _hash_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        for k, factor in enumerate((_FACTOR, _INVERSE)):
            steps = np.full(n + 1, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that are sorted and don't overlap, through prefix sums of a polynomial."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, base + STRETCH, "right")))
        n = int(ends[last - 1]) - base
        power, inverse = _hash_powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[base : base + n].astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((sums[e] - sums[s]) * inverse[s])
        first = last
    return out


class Words:
    """The words of a text column: ``starts`` and ``ends`` in ``data``, ``doc``, ``first`` (their place in the list of all
    words per document, one more than documents) and ``hashes``."""

    def __init__(self, column: pa.Array, in_word: np.ndarray, hashed: bool = True):
        raw, self.offsets = buffer(column)
        self.data = LOWER[raw]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = in_word[self.data]
        begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(raw))]
        begins[edges] = inside[1:-1][edges]
        ends[edges - 1] = inside[1:-1][edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.doc = np.repeat(np.arange(len(column)), np.diff(self.first))
        if hashed:
            self.hashes = span_hashes(self.data, self.starts, self.ends)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words at every place where so many follow."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _FACTOR + hashes[k : k + n]
    return mix(out)


def doc_runs(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(places, hashes)`` of the runs that lie within one document."""
    hashes = runs(words.hashes, size)
    whole = words.doc[: len(hashes)] == words.doc[size - 1 :][: len(hashes)]
    places = np.flatnonzero(whole)
    return places, hashes[places]
