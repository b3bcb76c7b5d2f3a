"""Token counts of whole texts by finite-state transducers compiled from a byte-level BPE tokenizer file.

Two deterministic transducers in a row give exactly the library's number of tokens.

*Splitter.* A transducer over character classes marks where words (pre-tokens) begin: runs of letters, digits or other marks with
an optional blank before them, contractions, white space. Marks that depend on the next characters are emitted one late. A batch
of texts is one string of characters, cut into chunks of equal length that step together in numpy. Each chunk yields its map
from every entry state to its exit state; a parallel prefix scan composes the maps, which tells each chunk its entry state.

*Merger.* A transducer over the bytes of a word. Its state after a prefix holds every suffix that may still grow into a token, the
token before that suffix, and the number of tokens before it. A token can end here only next to a token it wouldn't have
merged with, which is decided on the merge ranks of the two; exactly one does. The transition is annotated with the change
of the token count. States and transitions are compiled when text first needs them, and kept in sorted arrays for all
further batches of the worker; beyond ``MAX_TRANSITIONS`` compilation starts anew. Words step together, byte by byte; long words
are cut into pieces that step together too, and the pieces' maps are composed.

Special tokens of the file inside a text count one each and split the text, as the library does by default. Null and empty texts
have no bytes and no tokens.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigram.llm.common import importable, map_batches, vocabulary_text
from lexigram.llm.words import blocks, buffer, span_hashes

MAX_TRANSITIONS = 1_000_000
CHUNK = 256
LIMIT = 1024
#: Words of more bytes than ``LONG`` are cut into pieces; so many bytes before a piece are read to find its entry state.
LONG, PIECE, WARM = 2048, 256, 64
#: New transitions looked up one by one before they are sorted in.
FRESH = 5_000

# ---- splitter ----

#: Character classes. The letters of contractions have classes of their own.
BLANK, SPACE, LETTER, DIGIT, OTHER, QUOTE, ONE, R, V, E, L, EDGE = range(12)
N_CLASSES = 12
#: States: at the beginning; after one blank or other space; after several, ending in a blank or other space; in a run of letters,
#: digits, other marks; after a quote that begins a word; after such a quote and r, v or l.
(BEGIN, BLANK1, SPACE1, BLANKS, SPACES, IN_LETTERS, IN_DIGITS, IN_OTHER, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L) = range(12)
N_STATES = 12
#: Marks: a word begins at this character, at the one before.
HERE, BEFORE = 1, 2

_LETTERS = (LETTER, ONE, R, V, E, L)


def _fresh(c: int) -> tuple[int, int]:
    """State and marks when a word begins at a character of class ``c``."""
    if c == EDGE:
        return BEGIN, 0
    state = {BLANK: BLANK1, SPACE: SPACE1, DIGIT: IN_DIGITS, OTHER: IN_OTHER, QUOTE: QUOTED}.get(c, IN_LETTERS)
    return state, HERE


def _step(state: int, c: int) -> tuple[int, int]:
    if state in (BLANK1, SPACE1, BLANKS, SPACES) and c != EDGE:
        if c in (BLANK, SPACE):
            return (BLANKS if c == BLANK else SPACES), 0
        before = BEFORE if state in (BLANKS, SPACES) else 0
        if state in (SPACE1, SPACES):
            after, marks = _fresh(c)
            return after, marks | before
        return (IN_LETTERS if c in _LETTERS else IN_DIGITS if c == DIGIT else IN_OTHER), before
    if state == IN_LETTERS and c in _LETTERS or state == IN_DIGITS and c == DIGIT or state == IN_OTHER and c in (OTHER, QUOTE):
        return state, 0
    if state == QUOTED:
        if c in (OTHER, QUOTE):
            return IN_OTHER, 0
        if c in (ONE, R, V, L):
            return {ONE: BEGIN, R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}[c], 0
    if state in (QUOTED_R, QUOTED_V, QUOTED_L):
        if c == (L if state == QUOTED_L else E):
            return BEGIN, 0
        after, marks = (IN_LETTERS, 0) if c in _LETTERS else _fresh(c)
        return after, marks | BEFORE
    return _fresh(c)


_STEPS = [[_step(s, c) for c in range(N_CLASSES)] for s in range(N_STATES)]
NEXT = np.array([[n for n, _ in row] for row in _STEPS], np.int8).ravel()
MARKS = np.array([[m for _, m in row] for row in _STEPS], np.int8).ravel()


def character_classes() -> np.ndarray:
    """Class of every code point, asked of the tokenizer library's own regular expressions."""
    from tokenizers import Regex, pre_tokenizers

    points = np.array([*range(0xD800), *range(0xE000, 0x110000)], np.uint32)
    text = points.tobytes().decode("utf-32-le")
    classes = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        for begin in range(0, len(text), 65_536):
            for _, (a, b) in split.pre_tokenize_str(text[begin : begin + 65_536]):
                classes[points[begin + a : begin + b]] = kind
    for kind, letters in ((BLANK, " "), (QUOTE, "'"), (ONE, "stmd"), (R, "r"), (V, "v"), (E, "e"), (L, "l")):
        classes[[ord(x) for x in letters]] = kind
    return classes


def chunk_maps(lanes: np.ndarray, table: np.ndarray = NEXT) -> np.ndarray:
    """Exit state of each chunk (row) for each entry state (column). ``lanes``: classes, one column per chunk."""
    length, n = lanes.shape
    exits = np.empty((n, N_STATES), np.int8)
    # most chunks forget their entry state within a few characters: run all states only where they still differ
    open_lanes, states = np.arange(n), np.repeat(np.arange(N_STATES, dtype=np.int16)[:, None], n, axis=1)
    common, since = np.zeros(n, np.int16), np.full(n, length)
    at = 0
    while at < length and len(open_lanes):
        states = table[states * N_CLASSES + lanes[at, open_lanes]].astype(np.int16)
        at += 1
        same = (states == states[0]).all(axis=0)
        if same.any():
            common[open_lanes[same]], since[open_lanes[same]] = states[0, same], at
            open_lanes, states = open_lanes[~same], states[:, ~same]
    for step in range(int(since.min()) if n else length, length):
        moving = since <= step
        common = np.where(moving, table[common * N_CLASSES + lanes[step]], common).astype(np.int16)
    exits[:] = common[:, None]
    exits[open_lanes] = states.T
    return exits


def compose(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan: row ``k`` becomes the map of chunks 0 to ``k``, in a logarithmic number of rounds."""
    maps, gap = maps.copy(), 1
    while gap < len(maps):
        maps[gap:] = np.take_along_axis(maps[gap:], maps[:-gap].astype(np.int64), axis=1)
        gap *= 2
    return maps


def word_starts(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Places where words begin. The last class must be ``EDGE``."""
    n = -(-len(classes) // chunk)
    padded = np.full(n * chunk, EDGE, np.uint8)
    padded[: len(classes)] = classes
    lanes = np.ascontiguousarray(padded.reshape(n, chunk).T).astype(np.int16)
    state = np.zeros(n, np.int16)
    state[1:] = compose(chunk_maps(lanes))[:-1, BEGIN]
    marks = np.empty((chunk, n), np.int8)
    for step in range(chunk):
        key = state * N_CLASSES + lanes[step]
        marks[step] = MARKS[key]
        state = NEXT[key].astype(np.int16)
    marks = marks.T.ravel()
    begins = (marks & HERE) > 0
    begins[:-1] |= (marks[1:] & BEFORE) > 0
    return np.flatnonzero(begins[: len(classes)])


# ---- merger ----


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, by the published rule."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


_NEVER = 1 << 60


class Merger:
    """The transducer of one vocabulary, compiled as far as texts have needed it."""

    def __init__(self, vocabulary: str):
        model = json.loads(vocabulary)["model"]
        letters = _byte_letters()
        as_bytes = {t: bytes(letters[x] for x in t) for t in model["vocab"] if all(x in letters for x in t)}
        self.vocab = {as_bytes[t]: i for t, i in model["vocab"].items() if t in as_bytes}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = model["vocab"][left], model["vocab"][right]
            self.rank[a, b] = r
            self.parts.setdefault(model["vocab"][left + right], (a, b, r))
        # a tree of all tokens: children by (node, byte), the token that ends at a node, whether a node has children
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.grows: list[bool] = [False]
        for token, i in self.vocab.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.grows.append(False)
                    self.grows[node] = True
                node = self.child[key]
            self.token_at[node] = i
        self.spines: tuple[dict, dict] = {}, {}
        self.apart: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, int] = {((0, -1, 0),): 0}
        self.content: list[tuple] = [((0, -1, 0),)]
        self.keys = np.zeros(0, np.int64)
        self.target, self.change = np.zeros(0, np.int32), np.zeros(0, np.int16)
        self.fresh: dict[int, tuple[int, int]] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts at the left (0) or right (1) end of a token, smallest first, with the rank of the merge that made each."""
        known = self.spines[side]
        if token not in known:
            up, at = [], token
            while at in self.parts:
                a, b, r = self.parts[at]
                up.append((at, r))
                at = b if side else a
            known[token] = [(at, -1), *up[::-1]]
        return known[token]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens aren't merged across their border while they are built."""
        key = (left, right)
        if key not in self.apart:
            a, b = self._spine(left, 1), self._spine(right, 0)
            i = j = 0
            while True:
                next_a = a[i + 1][1] if i + 1 < len(a) else _NEVER
                next_b = b[j + 1][1] if j + 1 < len(b) else _NEVER
                across = self.rank.get((a[i][0], b[j][0]), _NEVER)
                if across < next_a and across <= next_b and across < _NEVER:
                    self.apart[key] = False
                    break
                if next_a == next_b == _NEVER:
                    self.apart[key] = True
                    break
                if next_a <= next_b:
                    i += 1
                else:
                    j += 1
        return self.apart[key]

    def _compile(self, key: int) -> tuple[int, int]:
        """Next state and change of the count for ``state << 8 | byte``."""
        byte, moved, ended = key & 255, [], None
        for node, before, count in self.content[key >> 8]:
            child = self.child.get(node << 8 | byte)
            if child is None:
                continue
            token = self.token_at[child]
            if token >= 0 and ended is None and (before < 0 or self.stay_apart(before, token)):
                ended = (token, count + 1)
            if self.grows[child]:
                moved.append((child, before, count))
        if ended is None:
            raise ValueError("the vocabulary lacks a byte")
        state = (*((n, t, c - ended[1]) for n, t, c in moved), (0, ended[0], 0))
        if state not in self.states:
            self.states[state] = len(self.content)
            self.content.append(state)
        return self.states[state], ended[1]

    def _merge(self) -> None:
        """Move new transitions to the sorted arrays."""
        if self.fresh:
            keys = np.fromiter(self.fresh, np.int64, len(self.fresh))
            values = np.array(list(self.fresh.values()), np.int64).reshape(-1, 2)
            keys = np.concatenate([self.keys, keys])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.target = np.concatenate([self.target, values[:, 0].astype(np.int32)])[order]
            self.change = np.concatenate([self.change, values[:, 1].astype(np.int16)])[order]
            self.fresh = {}

    def _settle(self) -> None:
        """End of a call: states are numbered anew once there are too many."""
        self._merge()
        if len(self.keys) > MAX_TRANSITIONS:
            self.clear()

    def _transitions(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        target, change = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
            target[known], change[known] = self.target[at[known]], self.change[at[known]]
        missing = np.flatnonzero(~known)
        if len(missing):
            unique, inverse = np.unique(keys[missing], return_inverse=True)
            for key in unique.tolist():
                if key not in self.fresh:
                    self.fresh[key] = self._compile(key)
            found = np.array([self.fresh[k] for k in unique.tolist()], np.int64)
            target[missing], change[missing] = found[inverse, 0], found[inverse, 1]
        return target, change

    def _run(self, data: np.ndarray, first: np.ndarray, size: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit state and change of the count of each byte span from its entry state."""
        order = np.argsort(-size, kind="stable")  # longest first: running spans stay in front
        first, left = first[order], size[order]
        state, total = entry[order], np.zeros(len(order), np.int64)
        step, running = 0, int((left > 0).sum())
        while running:
            target, change = self._transitions(state[:running] << 8 | data[first[:running] + step])
            state[:running] = target
            total[:running] += change
            step += 1
            running = int(np.searchsorted(-left, -step))
            if len(self.fresh) > FRESH:
                self._merge()
        exits, totals = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        exits[order], totals[order] = state, total
        return exits, totals

    def _long(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of long words, by composing the maps of their pieces.

        The last bytes before a piece nearly always settle the state in which it is entered, so all pieces run at once from the
        states found that way. What a piece does from a state is an entry of its map; composing looks entries up by
        the piece's bytes and the true state, and adds those that are missing.
        """
        cuts = [np.arange(s, e, PIECE) for s, e in zip(starts, ends)]
        first = np.concatenate(cuts)
        word = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
        size = np.minimum(first + PIECE, ends[word]) - first
        before = np.minimum(first - starts[word], WARM)
        entry, _ = self._run(data, first - before, before, np.zeros(len(first), np.int64))
        exits, totals = self._run(data, first, size, entry)
        content = [data[f : f + n].tobytes() for f, n in zip(first.tolist(), size.tolist())]
        known = {(c, int(s)): (int(x), int(t)) for c, s, x, t in zip(content, entry, exits, totals)}
        out, k = np.zeros(len(cuts), np.int64), 0
        for w, pieces in enumerate(cuts):
            state = 0
            for _ in range(len(pieces)):
                key = (content[k], state)
                if key not in known:
                    x, t = self._run(data, first[k : k + 1], size[k : k + 1], np.array([state]))
                    known[key] = (int(x[0]), int(t[0]))
                state, change = known[key]
                out[w] += change
                k += 1
        return out

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each byte span."""
        out = np.empty(len(starts), np.int64)
        long = ends - starts > LONG
        short = ~long
        out[short] = self._run(data, starts[short], (ends - starts)[short], np.zeros(int(short.sum()), np.int64))[1]
        if long.any():
            out[long] = self._long(data, starts[long], ends[long])
        self._settle()
        return out


# ---- both ----

_mergers: dict[int, Merger] = {}


def merger(vocabulary: str) -> Merger:
    """One per vocabulary and worker process."""
    key = hash(vocabulary)
    if key not in _mergers:
        _mergers[key] = Merger(vocabulary)
    return _mergers[key]


def special_tokens(vocabulary: str) -> list[str]:
    return sorted((t["content"] for t in json.loads(vocabulary).get("added_tokens") or []), key=lambda t: (-len(t), t))


def count(text: pa.Array, machine: Merger, classes: np.ndarray, special: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, tokens)`` of each text."""
    n = len(text)
    raw, offsets = buffer(text)
    sizes, extra, owner = np.diff(offsets), np.zeros(n, np.int64), np.arange(n)
    data = raw.tobytes()
    if any(s.encode() in data for s in special):
        pattern, parts, owners = re.compile("|".join(re.escape(s) for s in special)), [], []
        for k, value in enumerate(text.to_pylist()):
            pieces = pattern.split(value or "")
            extra[k] = len(pieces) - 1
            parts += pieces
            owners += [k] * len(pieces)
        owner = np.array(owners)
        raw, offsets = buffer(pa.array(parts, pa.string()))
        data = raw.tobytes()
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    places = np.concatenate([[0], np.cumsum(width)])
    # one edge after every text: it ends all words
    edges = np.searchsorted(places, offsets[1:])
    lined = np.insert(classes[points], edges, EDGE)
    starts = word_starts(lined)
    starts -= np.searchsorted(edges + np.arange(len(edges)), starts)
    begin = places[starts]
    doc = np.searchsorted(offsets, begin, "right") - 1
    end = np.append(begin[1:], len(raw))
    end = np.minimum(end, offsets[1:][doc]) if len(doc) else end[:0]
    _, at, inverse = np.unique(span_hashes(raw, begin, end), return_index=True, return_inverse=True)
    tokens = machine.counts(raw, begin[at], end[at])[inverse]
    return sizes, extra + np.bincount(owner[doc], tokens, n).astype(np.int64)


def counted(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """``docs`` (any columns, one of them ``text``) with ``n_bytes`` and ``n_tokens``, replaced if there are such."""
    spark = importable(docs.sparkSession)
    source = vocabulary_text(vocabulary)
    shared = spark.sparkContext.broadcast((source, character_classes(), special_tokens(source)))
    docs = docs.withColumns({c: F.lit(0).cast("bigint") for c in ("n_bytes", "n_tokens")})

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        source, classes, special = shared.value
        machine, text = merger(source), batch.column(batch.schema.get_field_index("text"))
        found = [count(text.slice(a, b - a), machine, classes, special) for a, b in blocks(text)]
        new = {"n_bytes": np.concatenate([f[0] for f in found]), "n_tokens": np.concatenate([f[1] for f in found])}
        columns = [pa.array(new[f.name]) if f.name in new else c for f, c in zip(batch.schema, batch.columns)]
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_batches(docs, make, docs.schema)


def report(docs: DataFrame) -> DataFrame:
    rows = counted(docs.select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
