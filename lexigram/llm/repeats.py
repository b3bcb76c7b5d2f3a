"""Removal of passages that a document with a smaller id holds already, by sorted suffixes.

Texts are UTF-8 bytes. A byte goes if it lies in a string of ``WINDOW`` bytes (a window) that also starts in a document with a
smaller id. Windows never cross documents and are judged on the texts as given.

*Copies.* A document whose whole text a smaller id has loses everything (if it holds a window) and takes nothing from others that
its original doesn't; texts are compared by SHA-256. Copies take no part in what follows.

*Fragments.* Among the ``WINDOW - K + 1`` strings of ``K`` bytes within a window, the one with the smallest hash (the leftmost, if
equal) is its anchor. Consecutive windows with one anchor make a fragment, some 64 bytes. Equal windows have equal anchors,
so all occurrences of a window lie in fragments of one anchor.

*Which fragments count.* A window holds ``BESIDE`` more bytes before its anchor or after it, and the hashes of the anchor with these
are the fragment's codes. Documents are taken in packs of neighbouring ids. Each pack sends every code once, sorted and
written as differences, to the task of its hash range; codes met twice come back to the packs that hold them. Only fragments
with such codes go on, each different one once per pack, with the smallest and largest id that holds it there. A hash collision
only sends a fragment on in vain.

*Shards.* Fragments meet in shards by anchor, equal ones are brought together, and anchors that have several different fragments are
judged on the sorted suffixes of these (``induced``: external induced sorting, with common prefixes): neighbours with a
common prefix of ``WINDOW`` bytes or more begin with one window, whose smallest id decides. Shards have a stated size; one
anchor is never split over shards, so a shard may be much larger where an anchor has very many different fragments: sorting then
works from files. Decisions, runs of windows with the smallest id that holds them, are stored and go to the packs, where the
bytes are removed.

*What travels.* Texts, fragments and decisions are shuffled as compressed blocks of many rows. Texts are shuffled twice, to find
fragments and to remove bytes, and never written: packs number their fragments alike both times, whatever the order of rows.

Equality of passages is always decided on bytes, hashes only choose candidates. A null text is empty. Rows with a null doc_id neither lose
anything nor make others lose; rows that repeat an id are one document, which doesn't remove its own passages. An empty table
gives no rows. Columns with clashing names don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigram.llm.common import importable, likely_in, map_batches, release
from lexigram.llm.induced import joined, sorted_suffixes
from lexigram.llm.words import blocks, buffer, mix
from lexigram.session import stored

WINDOW = 50
K = 24
STRINGS = WINDOW - K + 1
LONGEST = WINDOW + STRINGS - 1
#: A window holds at least so many bytes before its anchor, or after it.
BESIDE = (WINDOW - K) // 2
#: Neighbouring ids of one pack, codes of one hash range and fragment bytes of one shard, about.
PACK = 512
RANGE = 1_000_000
SHARD = 8 * 2**20
#: Bits of an anchor's hash; texts are hashed in stretches of so many bytes.
BITS = 48
STRETCH = 1 << 16

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_EMPTY = np.zeros(0, np.int64)


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, factor, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWER, _BACK = _powers(_FACTOR, STRETCH + 1), _powers(_INVERSE, STRETCH + 1)


def _runs(data: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """``(first window, anchor hash, left, right)`` of each run of windows with one anchor, among the first ``n`` windows of a
    stretch. ``left`` and ``right`` are the hashes of the anchor with ``BESIDE`` bytes more before and after it, -1 if no window
    of the run holds those."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWER[: len(data)], out=sums[1:])
    hashes = mix((sums[K:] - sums[:-K]) * _BACK[: len(data) - K + 1]) >> np.uint64(64 - BITS)
    key = (hashes << np.uint64(64 - BITS)) | np.arange(len(hashes), dtype=np.uint64)
    least, width = key, 1
    while 2 * width <= STRINGS:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    anchor = np.minimum(least[: len(key) - STRINGS + 1], least[STRINGS - width :])[:n]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    place = (anchor[first] & np.uint64(STRETCH - 1)).astype(np.int64)
    last = np.append(first[1:], n) - 1

    def wider(begin: np.ndarray, held: np.ndarray, seed: int) -> np.ndarray:
        begin = np.where(held, begin, 0)
        code = mix(mix((sums[begin + K + BESIDE] - sums[begin]) * _BACK[begin]) ^ np.uint64(seed)) >> np.uint64(64 - BITS)
        return np.where(held, code.view(np.int64), -1)

    left, right = wider(place - BESIDE, place - first >= BESIDE, 1), wider(place, place - last <= BESIDE, 2)
    return first, (anchor[first] >> np.uint64(64 - BITS)).view(np.int64), left, right


class Fragments:
    """The fragments of a run of texts in order: ``begin``, ``size`` (bytes in ``data``), ``anchor``, ``left``, ``right``, ``doc``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        rows = [np.zeros((5, 0), np.int64)]
        at, end = 0, len(self.data)
        while at + WINDOW <= end:
            n = min(STRETCH - LONGEST, end - WINDOW + 1 - at)
            first, *codes = _runs(self.data[at : at + n + WINDOW - 1], n)
            rows.append(np.stack([first + at, np.append(first[1:], n) + at, *codes]))
            at += n
        rows = np.concatenate(rows, axis=1)  # begin, end (of the windows), anchor, left, right
        # windows that cross the end of a text are none: runs are cut at the ends of texts, and what crosses goes
        doc = np.searchsorted(self.offsets, rows[0], "right") - 1
        parts, docs = [rows], [doc]
        while rows.shape[1]:
            doc = doc + 1
            inside = doc < len(self.offsets) - 1
            rows, doc = rows[:, inside], doc[inside]
            rows = np.concatenate([np.maximum(rows[:1], self.offsets[doc]), rows[1:]])
            on = rows[0] < rows[1]
            rows, doc = rows[:, on], doc[on]
            parts.append(rows)
            docs.append(doc)
        rows, doc = np.concatenate(parts, axis=1), np.concatenate(docs)
        last = np.minimum(rows[1], self.offsets[np.minimum(doc + 1, len(self.offsets) - 1)] - WINDOW + 1)
        good = np.flatnonzero(last > rows[0])
        good = good[np.argsort(rows[0, good], kind="stable")]
        self.begin, _, self.anchor, self.left, self.right = rows[:, good]
        self.doc, self.size = doc[good], (last - rows[0])[good] + WINDOW - 1

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """``(code, doc)``: both codes of all fragments that have them."""
        code, doc = np.concatenate([self.left, self.right]), np.concatenate([self.doc, self.doc])
        return code[code >= 0], doc[code >= 0]

    def padded(self, at: np.ndarray) -> np.ndarray:
        """Bytes of the fragments ``at`` as rows, zeros behind."""
        place = self.begin[at][:, None] + np.arange(LONGEST)
        rows = self.data[np.minimum(place, len(self.data) - 1)]
        rows[np.arange(LONGEST) >= self.size[at][:, None]] = 0
        return rows


def _alike(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For every row the first row that is equal to it (hashed, then compared)."""
    if not len(rows):
        return _EMPTY
    words = np.zeros((len(rows), -(-LONGEST // 8) * 8), np.uint8)
    words[:, :LONGEST] = rows
    mark = mix(size.astype(np.uint64))
    for column in words.view(np.uint64).T:
        mark = mix(mark * _FACTOR + column)
    order = np.argsort(mark, kind="stable")
    first = np.append(True, mark[order][1:] != mark[order][:-1])
    same = np.empty(len(rows), np.int64)
    same[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    differ = (size != size[same]) | (rows != rows[same]).any(axis=1)
    same[differ] = np.flatnonzero(differ)  # equal hashes of different fragments: each stays alone
    return same


def _coded(values: np.ndarray) -> bytes:
    """Ascending numbers as byte planes of their differences, which compress well."""
    return np.diff(values, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _decoded(code: bytes) -> np.ndarray:
    planes = np.frombuffer(code, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


#: A compressed block: number columns of ``n`` rows, then their bytes.
BLOCK = "n int, raw bigint, block binary"
_BLOCK = [("n", pa.int32()), ("raw", pa.int64()), ("block", pa.binary())]


def _squeezed(numbers: list[np.ndarray], data: bytes = b"") -> tuple[int, int, bytes]:
    plain = b"".join([*(_coded(v) for v in numbers), data])
    return len(numbers[0]), len(plain), pa.compress(plain, codec="zstd", asbytes=True)


def _opened(rows: pa.Table, columns: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Number columns and bytes of each block."""
    for n, raw, block in zip(*(rows[c] for c, _ in _BLOCK)):
        n = n.as_py()
        plain = pa.decompress(block.as_py(), decompressed_size=raw.as_py(), codec="zstd", asbytes=True)
        yield [_decoded(plain[8 * n * k : 8 * n * (k + 1)]) for k in range(columns)], np.frombuffer(plain, np.uint8)[8 * n * columns :]


def _packed(docs: DataFrame) -> DataFrame:
    """``(pack, n, raw, block)``: ids and texts of neighbouring rows of a pack in one block."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for begin, end in blocks(batch.column(2)):
            pack, ids = (batch.column(k).slice(begin, end - begin).to_numpy() for k in (0, 1))
            data, offsets = buffer(batch.column(2).slice(begin, end - begin))
            order = np.argsort(pack, kind="stable")
            edges = np.flatnonzero(np.append(True, pack[order][1:] != pack[order][:-1]))
            for b, e in zip(edges, [*edges[1:], len(order)]):
                own = order[b:e]
                texts = b"".join(data[offsets[i] : offsets[i + 1]].tobytes() for i in own)
                out.append((int(pack[own[0]]), *_squeezed([ids[own], np.diff(offsets)[own]], texts)))
        schema = pa.schema([("pack", pa.int64()), *_BLOCK])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return map_batches(docs.select("pack", "doc_id", "text"), make, f"pack bigint, {BLOCK}")


def _anchors(docs: DataFrame, ranges: int) -> DataFrame:
    """``(part, pack, several, codes)``: the codes of packs by hash range, those of several documents apart."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        packs = batch.column(0).to_numpy()
        rows = []
        for begin, end in blocks(batch.column(1)):
            found = Fragments(*buffer(batch.column(1).slice(begin, end - begin)))
            code, owner = found.codes()
            pack = packs[begin:end][owner]
            for p in np.unique(pack):
                mine = pack == p
                anchor, doc = code[mine], owner[mine]
                order = np.argsort(anchor, kind="stable")
                anchor, doc = anchor[order], doc[order]
                first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
                several = np.maximum.reduceat(doc, first) != np.minimum.reduceat(doc, first)
                for flag in (False, True):
                    own = anchor[first[several == flag]]
                    part = ((own >> 16) * ranges) >> (BITS - 16)
                    edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(own) else _EMPTY
                    for b, e in zip(edges, [*edges[1:], len(own)]):
                        rows.append((int(part[b]), int(p), flag, _coded(own[b:e])))
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "pack", "several", "codes"])

    return map_batches(docs.select("pack", "text"), make, "part int, pack bigint, several boolean, codes binary")


def _shared(anchors: DataFrame) -> DataFrame:
    """``(pack, codes)``: the codes of each pack that occur elsewhere too."""

    def meet(rows: pa.Table) -> pa.Table:
        values = [_decoded(c) for c in rows["codes"].to_pylist()]
        owner = np.repeat(np.arange(len(values)), [len(v) for v in values])
        value = np.concatenate(values)
        counts = np.array(rows["several"].to_numpy(zero_copy_only=False), bool)[owner]
        order = np.argsort(value, kind="stable")
        value, owner, known = value[order], owner[order], counts[order]
        first = np.append(True, value[1:] != value[:-1])
        group = np.cumsum(first) - 1
        often = (np.bincount(group) > 1) | (np.bincount(group, known) > 0)
        at = np.flatnonzero(often[group])
        at = at[np.argsort(owner[at], kind="stable")]
        edges = np.flatnonzero(np.append(True, owner[at][1:] != owner[at][:-1])) if len(at) else _EMPTY
        packs = rows["pack"].to_numpy()
        ends = [*edges[1:], len(at)]
        release()
        return pa.table({
            "pack": pa.array([int(packs[owner[at[b]]]) for b in edges], pa.int64()),
            "codes": pa.array([_coded(value[at[b:e]]) for b, e in zip(edges, ends)], pa.binary()),
        })

    return anchors.groupBy("part").applyInArrow(meet, "pack bigint, codes binary")


def _digest(data: np.ndarray) -> str:
    return hashlib.sha256(data.tobytes()).hexdigest()


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _whole(ids, texts: pa.Array) -> pa.Table:
    """Results of documents that keep everything."""
    data, offsets = buffer(texts)
    digests = [_digest(data[b:e]) for b, e in zip(offsets, offsets[1:])]
    zeros = np.zeros(len(texts), np.int64)
    return pa.table([ids, np.diff(offsets), zeros, zeros, digests], schema=_RESULT)


def _held(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values are among the ascending ``wanted``."""
    at = np.searchsorted(wanted, values)
    return np.append(wanted, -1)[at] == np.where(values < 0, -2, values)


class Pack:
    """Documents of a pack in order of id and text, and their fragments with a wanted code: ``doc``, ``place`` (in the document),
    and ``idx``, the number of the fragment among the different ones (``rows``, ``size``, ``anchor``)."""

    def __init__(self, texts: pa.Table, codes: list[bytes]):
        found = [(ids, sizes, data) for (ids, sizes), data in _opened(texts, 2)]
        ids, sizes = (np.concatenate([f[k] for f in found]) for k in range(2))
        data = np.concatenate([f[2] for f in found])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        parts = [data[b:e] for b, e in zip(offsets, offsets[1:])]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], _digest(parts[i])))
        self.ids, self.data = ids[order], np.concatenate([parts[i] for i in order])
        self.offsets = np.concatenate([[0], np.cumsum(sizes[order])])
        wanted = np.unique(np.concatenate([_decoded(c) for c in codes])) if codes else _EMPTY
        kinds, first = [], 0
        while first < len(ids):
            last = max(first + 1, int(np.searchsorted(self.offsets, self.offsets[first] + 2 * STRETCH, "right")) - 1)
            begin = self.offsets[first]
            own = Fragments(self.data[begin : self.offsets[last]], self.offsets[first : last + 1] - begin)
            at = np.flatnonzero(_held(own.left, wanted) | _held(own.right, wanted))
            kinds.append((own.padded(at), own.size[at], own.anchor[at], own.doc[at] + first, own.begin[at] - own.offsets[own.doc[at]]))
            first = last
        rows, size, anchor, self.doc, self.place = (np.concatenate([k[c] for k in kinds]) for c in range(5))
        firsts, self.idx = np.unique(_alike(rows, size), return_inverse=True)
        self.rows, self.size, self.anchor = rows[firsts], size[firsts], anchor[firsts]


def _cut(docs: DataFrame, shared: DataFrame, shards: int) -> DataFrame:
    """``(shard, pack, n, raw, block)``: the fragments of packs by shard, each different one of a pack once, with number, anchor,
    size, smallest id and how far the largest one is from it."""
    schema = pa.schema([("shard", pa.int64()), ("pack", pa.int64()), *_BLOCK])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        pack = Pack(left, right["codes"].to_pylist())
        low, high = np.full(len(pack.size), 2**63 - 1), np.full(len(pack.size), -(2**63))
        np.minimum.at(low, pack.idx, pack.ids[pack.doc])
        np.maximum.at(high, pack.idx, pack.ids[pack.doc])
        shard = pack.anchor % shards
        order = np.argsort(shard, kind="stable")
        edges = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1])) if len(order) else _EMPTY
        number, out = left["pack"][0].as_py(), []
        for b, e in zip(edges, [*edges[1:], len(order)]):
            own = order[b:e]
            data = pack.rows[own][np.arange(LONGEST) < pack.size[own][:, None]].tobytes()
            block = _squeezed([own, pack.anchor[own], pack.size[own], low[own], high[own] - low[own]], data)
            out.append((int(shard[own[0]]), number, *block))
        release()
        return _table(out, schema)

    return docs.groupBy("pack").cogroup(shared.groupBy("pack")).applyInArrow(cut, f"shard bigint, pack bigint, {BLOCK}")


def judged(rows: np.ndarray, size: np.ndarray, anchor: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first, owner)``: for the windows of all fragments in turn the smallest id of a document that holds them; fragment ``i`` has
    the windows from ``first[i]`` to ``first[i + 1]``."""
    windows = size - WINDOW + 1
    first = np.concatenate([[0], np.cumsum(windows)])
    same = _alike(rows, size)
    least = np.full(len(rows), 2**63 - 1)
    np.minimum.at(least, same, low)
    owner = np.repeat(least[same], windows)
    heads = np.flatnonzero(same == np.arange(len(same)))
    _, kind, variants = np.unique(anchor[heads], return_inverse=True, return_counts=True)
    heads = heads[variants[kind] > 1]
    if not len(heads):
        return first, owner
    inside = np.arange(LONGEST) < size[heads][:, None]
    text, starts = joined(rows[heads][inside], size[heads])
    pos, lcp = sorted_suffixes(text, starts, WINDOW)
    # a window begins where enough bytes follow in its fragment
    of = np.searchsorted(starts, pos, "right") - 1
    place = pos - starts[of] - 1
    new = lcp < WINDOW
    keep = place < windows[heads][of]
    group = np.cumsum(new)
    of, place, group = of[keep], place[keep], group[keep]
    found = np.full(int(group[-1]) + 1, 2**63 - 1)
    np.minimum.at(found, group, least[heads[of]])
    by_head = np.empty(int(windows[heads].sum()), np.int64)
    begin = np.concatenate([[0], np.cumsum(windows[heads])])
    by_head[begin[of] + place] = found[group]
    # what holds for a fragment holds for the equal ones
    which = np.full(len(rows), -1)
    which[heads] = np.arange(len(heads))
    which = which[same]
    several = np.flatnonzero(which >= 0)
    n = windows[several]
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    owner[np.repeat(first[several], n) + step] = by_head[np.repeat(begin[which[several]], n) + step]
    return first, owner


def _decided(fragments: DataFrame) -> DataFrame:
    """``(pack, n, raw, block)``: runs of windows (number of the fragment, first and last window) and the smallest id that holds
    them, where some document of the pack has a larger one."""
    schema = pa.schema([("pack", pa.int64()), *_BLOCK])

    def shard(table: pa.Table) -> pa.Table:
        found = list(_opened(table, 5))
        number, anchor, size, low, more = (np.concatenate([f[0][k] for f in found]) for k in range(5))
        data = np.concatenate([f[1] for f in found])
        owner_pack = np.repeat(np.arange(len(found)), [len(f[0][0]) for f in found])
        del found
        begin = np.cumsum(size) - size
        rows = data[np.minimum(begin[:, None] + np.arange(LONGEST), len(data) - 1)]
        rows[np.arange(LONGEST) >= size[:, None]] = 0
        first, owner = judged(rows, size, anchor, low)
        of = np.repeat(np.arange(len(size)), np.diff(first))
        edge = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (of[1:] != of[:-1])))
        last = np.append(edge[1:], len(owner)) - 1
        keep = owner[edge] < (low + more)[of[edge]]
        edge, last = edge[keep], last[keep]
        of = of[edge]
        # fragments lie pack by pack
        ends = np.searchsorted(owner_pack[of], np.arange(table.num_rows + 1))
        packs, out = table["pack"].to_pylist(), []
        for p, b, e in zip(packs, ends, ends[1:]):
            if b < e:
                o = of[b:e]
                out.append((p, *_squeezed([number[o], edge[b:e] - first[o], last[b:e] - first[o], owner[edge[b:e]]])))
        release()
        return _table(out, schema)

    return fragments.groupBy("shard").applyInArrow(shard, f"pack bigint, {BLOCK}")


def _removed(docs: DataFrame, shared: DataFrame, decisions: DataFrame) -> DataFrame:
    """The results of all documents of the packs."""

    def pack(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _RESULT.empty_table()
        decided = right["n"].is_valid()
        found = [columns for columns, _ in _opened(right.filter(decided), 4)]
        number, first, last, owner = (np.concatenate([f[k] for f in found]) if found else _EMPTY for k in range(4))
        order = np.argsort(number, kind="stable")
        number, first, last, owner = number[order], first[order], last[order], owner[order]
        # without decisions no fragments are looked for
        own = Pack(left, right.filter(pc.invert(decided))["codes"].to_pylist() if found else [])
        edges = np.searchsorted(own.doc, np.arange(len(own.ids) + 1))
        out = []
        for d, doc_id in enumerate(own.ids.tolist()):
            data = own.data[own.offsets[d] : own.offsets[d + 1]]
            place, idx = own.place[edges[d] : edges[d + 1]], own.idx[edges[d] : edges[d + 1]]
            begin, end = np.searchsorted(number, idx), np.searchsorted(number, idx, "right")
            n = end - begin
            at = np.repeat(begin, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            place, at = np.repeat(place, n)[owner[at] < doc_id], at[owner[at] < doc_id]
            depth = np.zeros(len(data) + 1, np.int32)
            np.add.at(depth, place + first[at], 1)
            np.add.at(depth, place + last[at] + WINDOW, -1)
            gone = np.cumsum(depth)[:-1] > 0
            spans = int(np.count_nonzero(gone & ~np.append(False, gone[:-1])))
            out.append((doc_id, len(data), int(gone.sum()), spans, _digest(data[~gone])))
        release()
        return _table(out, _RESULT)

    sides = shared.unionByName(decisions, allowMissingColumns=True)
    return docs.groupBy("pack").cogroup(sides.groupBy("pack")).applyInArrow(pack, RESULT)


def _copies(known: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, digest)`` of documents whose whole text a document with a smaller id has."""
    n_bytes = F.octet_length("text").cast("bigint").alias("n_bytes")
    marks = stored(known.select("doc_id", n_bytes, F.sha2("text", 256).alias("digest")), "digests")
    first = marks.groupBy("digest").agg(F.min("doc_id").alias("first"))
    met = marks.join(first.select(F.concat("digest", F.lit("")).alias("digest"), "first"), "digest")  # its own shuffle: hot texts are split
    return stored(met.where("doc_id > first").select("doc_id", "n_bytes", "digest"), "copies")


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row of ``docs`` (doc_id, text, ...)."""
    importable(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    named = rows.where("doc_id is not null")
    copies = _copies(named)
    ids = copies.select("doc_id").distinct()
    perhaps = likely_in(ids, "doc_id")  # only texts that are likely copies are shuffled to tell
    marked = named.where(perhaps).withColumn("digest", F.sha2("text", 256))
    rest = marked.join(copies.select("doc_id", "digest").hint("shuffle_hash"), ["doc_id", "digest"], "left_anti").drop("digest")
    known = named.where(~perhaps).unionByName(rest).withColumn("pack", F.floor(F.col("doc_id") / PACK).cast("bigint"))

    total = named.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first()["n"] or 0
    shared = stored(_shared(_anchors(known, max(1, 4 * total // (STRINGS + 1) // RANGE))), "anchors")
    fragments = shared.agg(F.sum(F.octet_length("codes").cast("bigint") / 8).alias("n")).first()["n"] or 0
    shards = max(1, int(fragments * (WINDOW + STRINGS // 2)) // SHARD)
    packed = _packed(known)
    removed = _removed(packed, shared, stored(_decided(_cut(packed, shared, shards)), "decided"))

    whole = F.col("n_bytes") >= WINDOW
    again = copies.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(0).alias("n_removed"),
        whole.cast("bigint").alias("n_spans"), F.when(whole, hashlib.sha256().hexdigest()).otherwise(F.col("digest")).alias("kept_sha256"),
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _whole(batch.column(0), batch.column(1)).to_batches()

    nameless = rows.where("doc_id is null").mapInArrow(keep, RESULT)
    return removed.unionByName(again).unionByName(nameless)
