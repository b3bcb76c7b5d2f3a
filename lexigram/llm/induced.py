"""Sorted suffixes of many short strings by induced sorting, with their common prefixes.

The strings stand one after the other, each behind a separator that sorts below every symbol and differs from the other
separators. A suffix is S if it is smaller than the suffix one symbol to its right, else L; an S suffix behind an L one is S*.

Suffixes are scanned in sorted order, and each induces the one to its left: it enters the queue of its own first symbol. One scan upwards
from the sorted S* suffixes sorts all L suffixes, one downwards from those sorts all S suffixes. What enters a queue arrives in
the order in which it must leave, since inducers are scanned in order; so the priority queue over (symbol, rank of the
inducer) is one first-in first-out queue per symbol. Its tuples carry the suffix and the length of its common prefix with the
one that entered before: one more than the least common prefix among the inducers between the two.

S* suffixes are sorted by the same two scans over the S* substrings, which get names in sorted order, and by recursion on the string
of names: if names repeat, pairs of names are named again, each time over twice the length.

Queues hold their tuples in memory up to a limit, beyond that in a file that goes with the sorter; the long arrays lie in such
files too when they are large. Scans take a queue piece by piece, so memory depends on the limits and not on the strings.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

SYMBOLS = 257
#: Bytes of queued tuples kept in memory, and entries of an array from which on it lies in a file.
QUEUED = 64 * 2**20
LARGE = 64 * 2**20
#: Suffixes scanned at a time.
PIECE = 4 * 2**20


def long_array(n: int, dtype) -> np.ndarray:
    """An array, in a file without a name if it is large."""
    if n < LARGE:
        return np.empty(n, dtype)
    with tempfile.TemporaryFile() as file:
        file.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(file, dtype, "r+", shape=(n,))


class Spool:
    """Arrays that are put away and fetched once, in memory up to ``limit`` bytes, else in a file."""

    def __init__(self, limit: int | None = None):
        self.limit, self.held, self.file = QUEUED if limit is None else limit, 0, None

    def put(self, *arrays: np.ndarray):
        size = sum(a.nbytes for a in arrays)
        if self.held + size <= self.limit:
            self.held += size
            return arrays
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        begin = self.file.seek(0, 2)
        for a in arrays:
            self.file.write(a.tobytes())
        return begin, [(a.dtype, len(a)) for a in arrays]

    def get(self, kept) -> tuple[np.ndarray, ...]:
        if isinstance(kept[0], np.ndarray):
            self.held -= sum(a.nbytes for a in kept)
            return kept
        self.file.seek(kept[0])
        return tuple(np.frombuffer(self.file.read(n * kind.itemsize), kind) for kind, n in kept[1])


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes at ``a`` and ``b``, up to ``cap``; separators are never equal."""
    out = np.zeros(len(a), np.uint8)
    active = np.arange(len(a))
    for k in range(cap):
        x = text[a[active] + k]
        active = active[(x == text[b[active] + k]) & (x > 0)]
        if not len(active):
            break
        out[active] = k + 1
    return out


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least value in each range ``begin .. end`` (both included)."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        last, step = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(last[:-step], last[step:]))
    depth = np.frexp((end - begin + 1).astype(np.float64))[1] - 1
    out = np.empty(len(begin), values.dtype)
    for k in np.unique(depth):
        at = depth == k
        out[at] = np.minimum(levels[k][begin[at]], levels[k][end[at] - (1 << int(k)) + 1])
    return out


class _Scan:
    """One scan over sorted suffixes, upwards (inducing L) or downwards (inducing S)."""

    def __init__(self, text: np.ndarray, cap: int, up: bool):
        self.text, self.cap, self.up = text, cap, up
        self.queues: list[list] = [[] for _ in range(SYMBOLS)]
        self.waiting = np.full(SYMBOLS, cap, np.uint8)  # least common prefix since the last one that entered a queue
        self.spool, self.last = Spool(), -1

    def induce(self, pos: np.ndarray, lcp: np.ndarray, c: int, same: bool) -> None:
        """Suffixes in the order of the scan, with their common prefix with the one scanned before; ``same``: they were induced."""
        for begin in range(0, len(pos), PIECE):
            self._induce(pos[begin : begin + PIECE], lcp[begin : begin + PIECE], c, same)

    def _induce(self, pos: np.ndarray, lcp: np.ndarray, c: int, same: bool) -> None:
        before = self.text[pos - 1]
        if self.up:
            keep = before >= c if same else before > c
        else:
            keep = (before <= c if same else before < c) & (before > 0)
        at = np.flatnonzero(keep)
        symbols = before[at]
        order = np.argsort(symbols, kind="stable")
        at, symbols = at[order], symbols[order]
        after = np.append(np.minimum.accumulate(lcp[::-1])[::-1], np.uint8(self.cap))  # least from a place on
        old = self.waiting
        self.waiting = np.minimum(old, after[0])
        if len(at):
            first = np.append(True, symbols[1:] != symbols[:-1])
            begin = np.where(first, 0, np.append(0, at[:-1] + 1))
            least = _least(lcp, begin, at)
            least[first] = np.minimum(least[first], old[symbols[first]])
            value = np.minimum(least + 1, self.cap).astype(np.uint8)
            edges = [*np.flatnonzero(first), len(at)]
            for b, e in zip(edges, edges[1:]):
                self.queues[symbols[b]].append(self.spool.put(pos[at[b:e]] - 1, value[b:e]))
                self.waiting[symbols[b]] = after[at[e - 1] + 1]
        self.last = int(pos[-1])

    def drain(self, c: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The queue of a symbol piece by piece; each piece induces before the next one leaves."""
        fresh = True
        while self.queues[c]:
            pos, lcp = self.spool.get(self.queues[c].pop(0))
            if fresh:
                lcp, fresh = lcp.copy(), False
                lcp[0] = 0
            yield pos, lcp
            self.induce(pos, lcp, c, True)

    def seeds(self, pos: np.ndarray, lcp: np.ndarray, c: int, fresh: bool) -> None:
        """Suffixes that are not induced by this scan, behind those of the same symbol that are."""
        lcp = lcp.copy()
        lcp[0] = 0 if fresh else common(self.text, pos[:1], np.array([self.last]), self.cap)[0]
        self.induce(pos, lcp, c, False)


def _scans(text: np.ndarray, starts: np.ndarray, star: np.ndarray, lcp: np.ndarray, cap: int):
    """``(c, L suffixes, their lcp, S suffixes, their lcp)`` per symbol, downwards. ``starts``: the separators; ``star``: S* suffixes by
    first symbol, sorted (or in text order, to sort the S* substrings)."""
    spool, lower = Spool(), []
    up = _Scan(text, cap, True)
    edges = np.searchsorted(text[star], np.arange(SYMBOLS + 1))
    for c in range(SYMBOLS):
        if c == 0:
            up.seeds(starts, np.zeros(len(starts), np.uint8), 0, True)
            lower.append([])
            continue
        pieces = []
        for piece in up.drain(c):
            pieces.append(spool.put(*piece))
        lower.append(pieces)
        if edges[c] < edges[c + 1]:
            own = slice(edges[c], edges[c + 1])
            up.seeds(star[own], lcp[own], c, not pieces)
    down = _Scan(text, cap, False)
    for c in range(SYMBOLS - 1, 0, -1):
        high = list(down.drain(c))
        pieces = [spool.get(p) for p in lower[c]]
        low = [np.concatenate([p[k] for p in pieces]) if pieces else np.zeros(0, t) for k, t in ((0, np.int64), (1, np.uint8))]
        if len(low[0]):
            down.seeds(low[0][::-1], np.append(np.uint8(0), low[1][:0:-1]), c, not high)
        pos = np.concatenate([p for p, _ in high])[::-1] if high else np.zeros(0, np.int64)
        near = np.concatenate([v for _, v in high])[::-1] if high else np.zeros(0, np.uint8)
        yield c, *low, pos, np.append(np.uint8(0), near[:-1])[: len(pos)]  # each with the next smaller one


def _stars(text: np.ndarray) -> np.ndarray:
    """Where the S* suffixes begin, in text order."""
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16)).astype(np.int8)
    step = np.append(step, np.int8(-1))
    step[text == 0] = -1  # a separator ends what stands before it
    at = np.where(step != 0, np.arange(len(step)), len(step))
    at = np.minimum.accumulate(at[::-1])[::-1]
    small = step[np.minimum(at, len(step) - 1)] > 0
    return np.flatnonzero(small[1:] & ~small[:-1] & (text[:-1] > 0) & (text[1:] > 0)) + 1


def _named(text: np.ndarray, star: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ranks of the S* suffixes (in text order), from the names of their substrings and of ever longer runs of names."""
    order = np.argsort(text[star], kind="stable")
    is_star = np.zeros(len(text), bool)
    is_star[star] = True
    found = []
    for _, _, _, pos, _ in _scans(text, starts, star[order], np.zeros(len(star), np.uint8), 1):
        found.append(pos[is_star[pos]])
    ordered = np.concatenate(found[::-1])
    ends = np.sort(np.concatenate([star, starts]))
    length = np.append(ends, len(text))[np.searchsorted(ends, ordered, "right")] - ordered + 1
    same = length[1:] == length[:-1]
    todo, k = np.flatnonzero(same), 0
    while len(todo):
        a, b = ordered[todo] + k, ordered[todo + 1] + k
        equal = (text[a] == text[b]) & (text[a] > 0)
        same[todo[~equal]] = False
        k += 1
        todo = todo[equal]
        todo = todo[length[todo] > k]
    # the string of names: separators first, each its own name
    names = np.zeros(len(ends) + 1, np.int64)
    first = np.append(True, ~same)
    group = np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
    place = np.searchsorted(ends, ordered)
    names[place] = group + len(starts)
    names[np.searchsorted(ends, starts)] = np.arange(len(starts))
    reach = 1
    while True:
        sizes = np.bincount(group, minlength=len(ordered))
        tied = np.flatnonzero(sizes[group] > 1)
        if not len(tied):
            break
        at, own = place[tied], group[tied]
        ahead = names[np.minimum(at + reach, len(ends))]
        o = np.lexsort((ahead, own))
        at, own, ahead = at[o], own[o], ahead[o]
        new_group = np.append(True, own[1:] != own[:-1])
        new = new_group | np.append(True, ahead[1:] != ahead[:-1])
        i = np.arange(len(at))
        group[tied] = own + np.maximum.accumulate(np.where(new, i, 0)) - np.maximum.accumulate(np.where(new_group, i, 0))
        place[tied] = at
        names[place] = group + len(starts)
        reach *= 2
    out = np.empty(len(star), np.int64)
    out[np.searchsorted(star, ends[place])] = group
    return out


def joined(strings: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text, starts)``: symbols (byte + 1) of the strings, each behind a separator, and one separator at the end.

    ``strings`` holds all bytes in order. ``starts`` are the separators; a string begins right behind its own.
    """
    starts = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
    text = long_array(int(starts[-1]) + 1, np.uint16)
    is_symbol = np.ones(len(text), bool)
    is_symbol[starts] = False
    text[starts] = 0
    text[is_symbol] = strings.astype(np.uint16) + 1
    return text, starts


def sorted_suffixes(text: np.ndarray, starts: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, lcp)`` of all suffixes that begin with a symbol, in order; lcp with the one before, ``cap`` at most."""
    star = _stars(text)
    rank = _named(text, star, starts) if len(star) else star
    star = star[np.argsort(rank)]
    lcp = np.zeros(len(star), np.uint8)
    lcp[1:] = common(text, star[1:], star[:-1], cap)
    n = len(text) - len(starts)
    out, near = long_array(n, np.int64), long_array(n, np.uint8)
    end = n
    for _, low, low_near, high, high_near in _scans(text, starts, star, lcp, cap):
        if len(high):
            out[end - len(high) : end], near[end - len(high) : end] = high, high_near
            end -= len(high)
            near[end] = common(text, high[:1], low[-1:], cap)[0] if len(low) else 0
        out[end - len(low) : end], near[end - len(low) : end] = low, low_near
        end -= len(low)
    return out, near
