"""Near-duplicate documents: fast similarity sketches, banding, exact verification, connected components.

A document's set holds the 64-bit hashes of its distinct shingles of five words (all its words as one when it has fewer);
words are separated by blanks, A-Z lower-cased. Documents without words have an empty set and are linked with nothing.

*Sketch.* Round ``i`` of the first ``T`` rounds sends every shingle to a random bin with a random value in ``[i, i + 1)``;
round ``T + i`` sends all shingles to bin ``i``. A bin keeps its least value and a document stops once all bins are full, so
every coordinate fills after ``T`` more rounds at the latest, mostly after two or three. Equal coordinates estimate the
Jaccard similarity with the concentration of independent draws.

*Candidates.* Equal sets are one item. ``BANDS`` bands of ``ROWS`` coordinates make bucket keys; a pair at the threshold misses
all buckets with probability ``(1 - 0.75 ** 4) ** 40 = 2.5e-7``, one at 0.8 with 7e-10.

*Links without all pairs.* Only pairs whose sizes allow the threshold and whose byte sketches agree to within ``MARGIN`` of it
(over six standard deviations) are verified, by intersecting full sets. First every document is compared with the smallest
document it meets in any bucket. Buckets whose members are then in one component need nothing more. In the others the largest
component is the host, the rest are guests. Guests of a bucket meet each other there, in blocks of two parts of some ``BLOCK``
members, never two parts of one component. Guests meet a host in the bucket too, unless the host's members in all such
buckets together outnumber the host itself: then each guest meets the whole host once, and each member of the host
enters once, in how many bands whatever. For ``BEST_TURNS`` turns every document is compared with the member of another component
whose sketch is closest, which joins groups around their originals; the last turn verifies every pair that is left between
different components. Blocks with few candidates pass them on as pairs; in dense blocks (many documents just below the
threshold) the full sets come to the block, and only links leave it. No bucket, partner or candidate is capped.

In a bucket's block a pair is left to an earlier bucket if all four sketch bytes of an earlier band agree. That these bytes agree
where the coordinates differ, so that the pair is missed, has a probability of 1e-8.

A null or repeated ``doc_id`` is one node: rows that share it belong together; null ids are never linked and their
component is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigram.llm.common import importable, likely_in, map_batches, release
from lexigram.llm.components import components
from lexigram.llm.words import NOT_BLANK, STRETCH, Words, blocks, doc_runs, mix, runs
from lexigram.session import stored

SHINGLE = 5
PERCENT = 75
ROWS, BANDS = 4, 40
T = ROWS * BANDS
MARGIN = 0.25
BLOCK = 512
#: A block with more candidate pairs than this per member verifies them itself and passes on the links only.
DENSE = 16
BEST_TURNS = 1
#: Bucket members that one task compares at a time, whole blocks.
SHARD = 16_384
BLOCK_KEY = ["key", "part_a", "part_b"]


def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: the distinct shingle hashes of each text in ascending order, and where each text's begin."""
    words = Words(text, NOT_BLANK)
    places, hashes = doc_runs(words, SHINGLE)
    n_words, first = np.diff(words.first), np.searchsorted(places, words.first)
    sets = []
    for doc in range(len(text)):
        if n_words[doc] >= SHINGLE:
            sets.append(np.unique(hashes[first[doc] : first[doc + 1]]))
        else:
            sets.append(runs(words.hashes[words.first[doc] : words.first[doc + 1]], max(1, int(n_words[doc]))))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def sketches(hashes: np.ndarray, first: np.ndarray, t: int = T) -> np.ndarray:
    """One row of ``t`` coordinates per set; rows of empty sets hold the largest value."""
    n = len(first) - 1
    empty = np.uint64(2**64 - 1)
    out = np.full(n * t, empty, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(first))
    todo = np.ones(len(hashes), bool)
    for i in range(2 * t):
        h, rows = hashes[todo], owner[todo]
        if not len(h):
            break
        drawn = mix(h ^ mix(np.full(1, i + 1, np.uint64)))
        bins = (((drawn >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        value = (np.uint64(i) << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF))
        np.minimum.at(out, rows * t + bins, value)
        full = ~(out.reshape(n, t) == empty).any(axis=1)
        todo &= ~full[owner]
    return out.reshape(n, t)


def _bands(sketch: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sketch), BANDS), np.uint64) + mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for k in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + sketch[:, k::ROWS])
    return keys.view(np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, f1, f2, bands, sketch)``: size, 128-bit hash, band keys and byte sketch of each set."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for begin, end in blocks(batch.column(1), 2 * STRETCH):
            hashes, first = shingle_sets(batch.column(1).slice(begin, end - begin))
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(seed)))]) for seed in (1, 2)]
            marks = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
            sketch = sketches(hashes, first)
            sizes = np.diff(first)
            bands = _bands(sketch)
            width = np.where(sizes > 0, BANDS, 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32()), pa.array(bands[sizes > 0].ravel())
            )
            low = np.ascontiguousarray((sketch & np.uint64(0xFF)).astype(np.uint8))
            packed = pa.array([row.tobytes() for row in low], pa.binary())
            parts.append([pa.array(sizes), pa.array(marks[0]), pa.array(marks[1]), lists, packed])
        columns = [pa.concat_arrays([p[k] for p in parts]) for k in range(5)]
        names = ["doc_id", "n_shingles", "f1", "f2", "bands", "sketch"]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    schema = "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>, sketch binary"
    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), make, schema)


def _allowed(sizes: np.ndarray, size: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(sizes, size) >= PERCENT * np.maximum(sizes, size)


class _Block:
    """Rows of one or two parts that meet: key, part_a, part_b, band, part, doc, comp, n, sketch."""

    def __init__(self, rows: pd.DataFrame):
        self.docs, self.comps, self.sizes, self.parts = (rows[c].to_numpy() for c in ("doc", "comp", "n", "part"))
        self.sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
        self.earlier = self.sketch.view(np.uint32)[:, : int(rows["band"].iloc[0])]  # ROWS bytes each
        self.two_parts = rows["part_a"].iloc[0] != rows["part_b"].iloc[0]

    def candidates(self, i: int, begin: int) -> tuple[np.ndarray, np.ndarray]:
        """Members from ``begin`` on that ``i`` may be linked with, and estimates; pairs meet in their first bucket only."""
        rest = slice(begin, len(self.docs))
        fit = (self.comps[rest] != self.comps[i]) & _allowed(self.sizes[rest], self.sizes[i])
        if self.two_parts:
            fit &= self.parts[rest] != self.parts[i]
        at = np.flatnonzero(fit) + begin
        if len(at):
            at = at[~(self.earlier[at] == self.earlier[i]).any(axis=1)]
        same = (self.sketch[at] == self.sketch[i]).mean(axis=1) if len(at) else np.zeros(0)
        close = same >= PERCENT / 100 - MARGIN
        return at[close], same[close]


def _groups(rows: pd.DataFrame) -> Iterator[tuple[tuple, pd.DataFrame]]:
    rows = rows.sort_values([*BLOCK_KEY, "doc"], ignore_index=True)
    group = rows[BLOCK_KEY].to_numpy()
    edges = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
    for begin, end in zip([0, *edges], [*edges, len(rows)]):
        yield tuple(group[begin].tolist()), rows.iloc[begin:end]


def _closest(members: DataFrame) -> DataFrame:
    """For every document the pair ``(a, b)`` with the member of another component whose sketch is closest, ties to the
    smaller one. ``members`` as dealt by ``_blocked``."""

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in _groups(rows):
            own = _Block(block)
            for i in range(len(own.docs)):
                at, same = own.candidates(i, 0)
                if len(at):
                    best = int(np.argmax(same))
                    out.append((int(own.docs[i]), int(own.docs[at[best]]), float(same[best])))
        release()
        return pd.DataFrame(out, columns=["a", "b", "estimate"]).astype({"a": "int64", "b": "int64", "estimate": "float64"})

    found = members.groupBy("shard").applyInPandas(shard, "a bigint, b bigint, estimate double")
    order = F.struct("estimate", (-F.col("b")).alias("b"))
    best = found.groupBy("a").agg((-F.max(order)["b"]).alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _remaining(members: DataFrame) -> DataFrame:
    """All candidate pairs ``(a, b)`` of blocks with few of them; a row without a and b for each dense block."""

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for name, block in _groups(rows):
            own, found = _Block(block), []
            for i in range(len(own.docs)):
                found += [(int(own.docs[i]), int(own.docs[j]), *name) for j in own.candidates(i, i + 1)[0]]
                if len(found) > DENSE * len(own.docs):
                    found = [(None, None, *name)]
                    break
            out += found
        release()
        return pd.DataFrame(out, columns=["a", "b", *BLOCK_KEY]).astype({"a": "Int64", "b": "Int64"})

    return members.groupBy("shard").applyInPandas(shard, "a bigint, b bigint, key bigint, part_a int, part_b int")


def _dense_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of dense blocks, found on the full sets within each block."""

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc", ignore_index=True)
        own, out = _Block(rows), []
        shingles = [np.asarray(x) for x in rows["shingles"]]
        for i in range(len(own.docs)):
            at, _ = own.candidates(i, i + 1)
            if not len(at):
                continue
            others = np.concatenate([shingles[j] for j in at])
            mine = np.sort(shingles[i])
            held = mine[np.minimum(np.searchsorted(mine, others), len(mine) - 1)] == others
            first = np.concatenate([[0], np.cumsum([len(shingles[j]) for j in at])[:-1]])
            both = np.add.reduceat(held.astype(np.int64), first)
            either = np.array([len(shingles[j]) for j in at]) + len(mine) - both
            linked = at[100 * both >= PERCENT * either]
            out += [(int(own.docs[i]), int(own.docs[j])) for j in linked]
        del shingles
        release()
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return members.join(sets, "doc").groupBy(*BLOCK_KEY).applyInPandas(block, "a bigint, b bigint").distinct()


def _screened(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and byte sketches allow. ``items``: doc, n, sketch."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
        close = (x == y).mean(axis=1) >= PERCENT / 100 - MARGIN
        return batch.filter(pa.array(close)).select([0, 1])

    a, b = (items.select(*[F.col(c).alias(f"{c}_{side}") for c in items.columns]) for side in "ab")
    met = pairs.join(b, F.col("b") == F.col("doc_b")).join(a, F.col("a") == F.col("doc_a"))
    sized = met.where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    return map_batches(sized.select("a", "b", "sketch_a", "sketch_b"), make, "a bigint, b bigint").distinct()


def _parts(members: DataFrame) -> DataFrame:
    """``(key, comp, n_comp, begin, width, parts)``: a bucket's parts, by component. A component of more than half a block has
    ``width`` parts of its own from ``begin`` on; smaller ones share the first ``width`` parts."""
    sizes = stored(members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n_comp")), "sizes")
    large = F.col("n_comp") * 2 > BLOCK
    width = F.when(large, F.ceil(F.col("n_comp") / BLOCK)).otherwise(F.lit(0)).cast("int")
    own = sizes.where(large).withColumn("width", width)
    before = Window.partitionBy("key").orderBy("comp").rowsBetween(Window.unboundedPreceding, -1)
    own = own.select("key", "comp", "width", F.coalesce(F.sum("width").over(before), F.lit(0)).cast("int").alias("after"))
    rest = F.ceil(F.sum(F.when(~large, F.col("n_comp")).otherwise(0)) / BLOCK).cast("int")
    whole = stored(sizes.groupBy("key").agg(rest.alias("shared"), (rest + F.sum(width).cast("int")).alias("parts")), "whole")
    dealt = sizes.join(own, ["key", "comp"], "left").join(whole, "key")
    begin = F.when(F.col("width").isNull(), 0).otherwise(F.col("shared") + F.col("after"))
    return dealt.select("key", "comp", "n_comp", begin.alias("begin"), F.coalesce("width", "shared").alias("width"), "parts")


def _in_buckets(members: DataFrame) -> DataFrame:
    """Members (key, band, doc, comp) dealt into blocks of their bucket: key, part_a, part_b, band, part, doc, comp.

    Members of one component are not sent to meet each other: parts of a large component meet the other parts only, and a small
    one stays within one part.
    """
    parts = stored(_parts(members), "parts")
    alone = 2 * F.col("n_comp") > BLOCK
    mark = F.xxhash64(F.when(alone, F.col("doc")).otherwise(F.col("comp")))
    part = (F.col("begin") + F.pmod(mark, F.col("width"))).cast("int")
    met = F.filter(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda x: ~alone | (x < F.col("begin")) | (x >= F.col("begin") + F.col("width"))
    )
    dealt = members.join(parts, ["key", "comp"]).withColumn("part", part).withColumn("other", F.explode(met))
    own = [F.least("part", "other").alias("part_a"), F.greatest("part", "other").alias("part_b")]
    return dealt.select("key", *own, "band", "part", "doc", "comp")


def _at_hosts(hosts: DataFrame, guests: DataFrame) -> DataFrame:
    """Hosts (host, doc) and their guests (host, doc, comp) dealt into blocks of one part of either; parts of hosts are negative."""
    n_hosts = hosts.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("own"))
    n_guests = guests.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("from"))
    parts = n_hosts.join(n_guests, "host")
    sizes = stored(parts, "parts").select(F.col("host").bitwiseXOR(F.lit(0)).alias("host"), "own", "from")

    def dealt(rows: DataFrame, mine: str, others: str, comp: Column, negative: bool) -> DataFrame:
        part = F.pmod(F.xxhash64("doc"), F.col(mine)).cast("int")
        rows = rows.join(sizes, "host").withColumn("mine", part).withColumn("met", F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
        a, b = (F.col("mine"), F.col("met")) if negative else (F.col("met"), F.col("mine"))
        own = (-1 - a) if negative else b
        return rows.select(
            F.col("host").alias("key"), (-1 - a).alias("part_a"), b.alias("part_b"), F.lit(0).alias("band"), own.alias("part"),
            "doc", comp.alias("comp"),
        )

    return dealt(hosts, "own", "from", F.col("host"), True).unionByName(dealt(guests, "from", "own", F.col("comp"), False))


def _blocked(members: DataFrame, items: DataFrame) -> DataFrame:
    """Members of buckets (key, band, doc, comp) that have yet to meet, with size and sketch, dealt into blocks, and blocks into
    shards of bounded size."""
    residents = stored(members.select(F.col("comp").alias("host"), "doc").distinct(), "residents")
    sizes = stored(members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n_comp")), "sizes")
    first = F.struct("n_comp", (-F.col("comp")).alias("comp"))
    top = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), (-F.max(first)["comp"]).alias("host")).where("comps > 1")
    mixed = stored(sizes.join(top.select("key", "host"), "key"), "mixed")
    whole = residents.groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    entered = mixed.where("comp = host").groupBy("host").agg(F.sum("n_comp").alias("entered"))
    hosts = entered.join(whole, "host").where("entered > n_host").select("host")
    hosts = stored(hosts, "hosts")

    here = mixed.join(hosts.withColumnRenamed("host", "comp"), "comp", "left_anti").unionByName(
        mixed.where("comp != host").join(hosts.withColumnRenamed("host", "comp"), "comp", "left_semi")
    )
    several = here.groupBy("key").agg(F.count(F.lit(1)).alias("comps")).where("comps > 1").select("key")
    here = members.join(here.join(several, "key", "left_semi").select("key", "comp"), ["key", "comp"], "left_semi")
    calls = mixed.where("comp != host").join(hosts, "host", "left_semi").select("key", "comp", "host")
    guests = stored(members.join(calls, ["key", "comp"]).select("host", "doc", "comp").distinct(), "guests")
    at_home = residents.join(hosts, "host", "left_semi")
    dealt = stored(_in_buckets(here).unionByName(_at_hosts(at_home, guests)), "dealt")
    shards = max(1, dealt.count() // SHARD)
    rows = dealt.join(items, "doc")
    return rows.withColumn("shard", F.pmod(F.xxhash64(*BLOCK_KEY), F.lit(shards)))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc, n, shingles)`` of the wanted documents (doc)."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for begin, end in blocks(batch.column(1), 2 * STRETCH):
            hashes, first = shingle_sets(batch.column(1).slice(begin, end - begin))
            parts.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(hashes.view(np.int64))))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.concat_arrays(parts)], names=["doc", "shingles"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc"), "text")
    likely = rows.where(likely_in(wanted, "doc"))  # few texts are shuffled in vain, at any size
    return map_batches(likely.join(wanted.hint("shuffle_hash"), "doc", "left_semi"), make, "doc bigint, shingles array<bigint>")


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    ends = pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))).distinct()
    sets = stored(_sets(docs, stored(ends, "ends")), "sets")
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x"))
    left = left.join(pairs.select("a").distinct(), "a", "left_semi")
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    either = F.size("x") + F.size("y") - both
    same = pairs.join(right, "b").join(left, "a").where(100 * both >= PERCENT * either).select("a", "b")
    return stored(same.distinct(), "verified")


def classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs`` (doc_id, text, ...)."""
    importable(docs.sparkSession)
    marks = stored(fingerprints(docs), "fingerprints")
    ids = marks.where("n_shingles > 0 and doc_id is not null")
    equal = ids.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("first"))
    equal = equal.select(F.col("f1").bitwiseXOR(F.lit(0)).alias("f1"), "f2", "n_shingles", "first")  # a shuffle of its own: hot sets are split
    copies = stored(ids.join(equal, ["f1", "f2", "n_shingles"]).select("doc_id", "first"), "copies")
    firsts = copies.where("doc_id = first").select("doc_id").distinct()
    chosen = ids.join(firsts, "doc_id", "left_semi").select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch", "bands")
    items = chosen.drop("bands")

    members = chosen.select("doc", F.posexplode("bands").alias("band", "key")).distinct()
    buckets = members.groupBy("key").agg(F.min("doc").alias("pivot"), F.count(F.lit(1)).alias("total")).where("total > 1")
    buckets = buckets.select(F.col("key").bitwiseXOR(F.lit(0)).alias("key"), "pivot")
    members = stored(members.join(buckets, "key").select("key", "band", "doc", "pivot"), "members")
    star = members.where("doc != pivot").groupBy(F.col("doc").alias("b")).agg(F.min("pivot").alias("a"))
    tried = stored(_screened(star.select("a", "b"), items), "pairs")
    links = _verified(docs, tried)

    for turn in range(BEST_TURNS + 1):
        met = members.join(components(links).withColumnRenamed("node", "doc"), "doc", "left").select(
            "key", "band", "doc", F.coalesce("component", "doc").alias("comp")
        )
        blocked = _blocked(stored(met, "met"), items)
        found = stored(_closest(blocked) if turn < BEST_TURNS else _remaining(blocked), "pairs")
        pairs = found.where("a is not null").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        links, tried = links.unionByName(_verified(docs, pairs)), tried.unionByName(pairs)
    dense = found.where("a is null").select(*BLOCK_KEY)
    if not dense.isEmpty():
        blocked = blocked.join(dense, BLOCK_KEY, "left_semi")
        sets = stored(_sets(docs, stored(blocked.select("doc").distinct(), "ends")), "sets")
        links = links.unionByName(stored(_dense_links(blocked, sets), "verified"))

    links = links.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("first").alias("b")).where("a != b"))
    found = components(links).withColumnRenamed("node", "doc_id")
    rows = marks.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    return classes(docs).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def one_per_class(docs: DataFrame) -> DataFrame:
    """One document of each class, with its own columns; of rows that repeat an id, one. Rows without an id stay."""
    found = classes(docs).where("doc_id = component_id")
    kept = stored(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")), "kept")
    # hashed ids of one side are the smaller half at any size: texts are shuffled once and never sorted
    once = docs.join(kept.where("copies = 1").hint("shuffle_hash"), "doc_id", "left_semi")
    if not kept.where("copies > 1").isEmpty():
        once = once.unionByName(docs.join(kept.where("copies > 1"), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return once.unionByName(docs.where("doc_id is null")).select(*docs.columns)
