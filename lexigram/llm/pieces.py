"""Ids of whole texts from a tokenizer of the ``tokenizers`` library, through a bounded table of pieces.

The tokenizers used here never join a visible character to a single blank before the next word, to a single newline, nor a
letter or digit to an ASCII mark after it, nor an ASCII mark (but for a quote) to a letter or digit after it. Texts are cut at such
places, all of a batch at once in numpy; the pieces are encoded on their own. Most pieces repeat: the library sees a piece once
per worker, and ids of known pieces are gathered from one array by the 64-bit hash of the piece. Where a neighbour may be
white space beyond ASCII nothing is cut. Texts that hold a special token go to the library whole.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa

from lexigram.llm.words import buffer, span_hashes

#: Pieces kept, about 40 bytes each; a full table starts anew.
MAX_PIECES = 1_200_000

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
#: First bytes of the characters among which white space beyond ASCII is.
_MAYBE_BLANK = np.zeros(256, bool)
_MAYBE_BLANK[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:] = True
_BEGINS = _VISIBLE & ~_MAYBE_BLANK
_LATIN, _NO_LETTER = 0xC3, (0x97, 0xB7)


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin, in ascending order, for texts between ``offsets``."""
    n = len(data)
    b = np.zeros(n + 4, np.uint8)
    b[3 : n + 3] = data
    here, before, two, three, after = b[3 : n + 3], b[2 : n + 2], b[1 : n + 1], b[:n], b[4 : n + 4]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    inner = ~begins[:n]  # not the first byte of a text
    wide = (before >= 0x80) & ((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3)))
    alone = inner & _VISIBLE[before] & ~wide & _BEGINS[after] & ~begins[1:]
    at = (here == 0x20) & alone
    newline = (here == 0x0A) & alone
    latin_end = (two == _LATIN) & (before >= 0x80) & (before != _NO_LETTER[0]) & (before != _NO_LETTER[1])
    latin_begin = (here == _LATIN) & (after != _NO_LETTER[0]) & (after != _NO_LETTER[1])
    at |= newline
    at |= inner & _MARK[here] & (_ALNUM[before] | latin_end)
    at |= inner & _MARK[before] & (before != 0x27) & (_ALNUM[here] | latin_begin)
    at[1:] |= newline[:-1]
    at |= begins[:n]
    return np.flatnonzero(at)


class Encoder:
    """``batch(texts)``: ids of all texts in a row, and where each text's begin."""

    def __init__(self, vocabulary: str, max_pieces: int = MAX_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.max_pieces = max_pieces
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _library(self, texts: list[str]) -> list[array]:
        return [array("I", e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        """Put new pieces (ascending keys) into the table."""
        found = [x for begin in range(0, len(texts), 4096) for x in self._library(texts[begin : begin + 4096])]
        sizes = np.array([len(x) for x in found], np.int64)
        end = self.used + int(sizes.sum())
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(end, np.uint32)])
        self.ids[self.used : end] = np.frombuffer(b"".join([x.tobytes() for x in found]), np.uint32)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.first = np.insert(self.first, at, self.used + np.cumsum(sizes) - sizes)
        self.size = np.insert(self.size, at, sizes)
        self.used = end

    def _places(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return np.where(known, at, -1)

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``batch``, for texts without special tokens."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = cuts(data, offsets[:-1][np.diff(offsets) > 0])
        ends = np.append(starts[1:], len(data))
        keys, example, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.max_pieces:
            self._clear()
        places = self._places(keys)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            raw, at = data.tobytes(), example[missing]
            texts = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            self._learn(keys[missing], texts)
            places = self._places(keys)
        first, size = self.first[places][inverse], self.size[places][inverse].astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(sums[-1]) + np.repeat(first - sums[:-1], size)]
        return ids, sums[np.searchsorted(starts, offsets)]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = buffer(texts)
        raw = data.tobytes()
        if not any(s in raw for s in self.special):
            return self._plain(data, offsets)
        parts = []
        for k in range(len(texts)):
            text = raw[offsets[k] : offsets[k + 1]]
            if any(s in text for s in self.special):
                parts.append(np.array(self._library([text.decode()])[0], np.uint32))
            else:
                parts.append(self._plain(data[offsets[k] : offsets[k + 1]], np.array([0, len(text)]))[0])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def many(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, first = self.batch(texts)
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


_encoders: dict[int, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder per vocabulary and worker process."""
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]
