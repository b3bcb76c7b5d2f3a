"""Benchmark decontamination: a broadcast set of the benchmark's n-grams, one pass over the training texts.

Words are maximal runs of ASCII letters and digits and of everything beyond ASCII, A-Z lower-cased. A window is ``n``
consecutive words of an item, or the whole item when it has fewer. Windows travel to the workers as sorted 64-bit hashes; a
match of hashes is confirmed on the words themselves. At most ``MAX_WINDOWS`` windows are broadcast at a time: more are dealt
by hash into blocks, and the texts pass once per block.

Windows are broadcast without their items, each different one once, so a passage that very many items hold is one window. Texts
get the windows found; which items hold those is joined afterwards, once per different set of windows.

Null texts and texts without words have no windows and no hits; items with a null id or no words are never found; items that
repeat count once per id; a text that repeats is reported for each of its rows. An empty benchmark leaves every text clean.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigram.llm.common import boxed, importable, map_batches
from lexigram.llm.words import ALNUM, Words, blocks, doc_runs, runs
from lexigram.session import stored

WINDOW = 10
#: Different windows (with their words, some 200 bytes each) in one broadcast.
MAX_WINDOWS = 200_000

_PREFILTER_BITS = 20


def item_windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """``(item, size, key, words)``: every distinct window of every item."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column(1), ALNUM)
        ids, rows = batch.column(0).to_pylist(), set()
        for doc, item in enumerate(ids):
            first, last = int(words.first[doc]), int(words.first[doc + 1])
            size = min(n, last - first)
            if size and item is not None:
                keys = runs(words.hashes[first:last], size).view(np.int64)
                for k, key in enumerate(keys.tolist()):
                    text = b" ".join(words.text(first + k + i) for i in range(size))
                    rows.add((item, size, key, text))
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item", "size", "key", "words"])

    schema = "item string, size int, key bigint, words binary"
    return map_batches(items.select(F.col(items.columns[0]).cast("string"), items.columns[1]), make, schema).distinct()


def distinct_windows(listed: DataFrame) -> DataFrame:
    """``(size, key, words, variant)``: each different window once; ``key`` and ``variant`` name it, even if hashes collide."""
    by_key = Window.partitionBy("key").orderBy("size", "words")
    return listed.select("size", "key", "words").distinct().withColumn("variant", F.row_number().over(by_key))


class _Index:
    """Windows of one size: sorted hashes, and for each hash its word sequences with their variants."""

    def __init__(self, rows: list):
        found: dict[int, dict[bytes, int]] = {}
        for r in rows:
            found.setdefault(r.key & (2**64 - 1), {})[bytes(r.words)] = r.variant
        self.keys = np.array(sorted(found), np.uint64)
        self.values = [found[int(k)] for k in self.keys]
        self.seen = np.zeros(1 << _PREFILTER_BITS, bool)
        self.seen[self.keys >> np.uint64(64 - _PREFILTER_BITS)] = True

    def matches(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose hash is a window's, and which."""
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(64 - _PREFILTER_BITS)])
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        same = self.keys[at] == hashes[maybe]
        return maybe[same], at[same]


def _merged(ranges: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(r) for r in out]


FOUND = "array<struct<key:bigint,variant:int>>"


def _scan_block(docs: DataFrame, index) -> DataFrame:
    """``docs`` (text, windows, ranges, ...) with the hits of one block of windows added."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column(batch.schema.get_field_index("text"))
        place_windows, place_ranges = (batch.schema.get_field_index(c) for c in ("windows", "ranges"))
        old_windows, old_ranges = batch.column(place_windows).to_pylist(), batch.column(place_ranges).to_pylist()
        new = [{(w["key"], w["variant"]) for w in ws} for ws in old_windows]
        counts = np.zeros(batch.num_rows, np.int64)
        for begin, end in blocks(text):
            words = Words(text.slice(begin, end - begin), ALNUM)
            counts[begin:end] = np.diff(words.first)
            for size, windows in index.value.items():
                places, hashes = doc_runs(words, size)
                hits, which = windows.matches(hashes)
                for place, w in zip(places[hits].tolist(), which.tolist()):
                    variant = windows.values[w].get(b" ".join(words.text(place + i) for i in range(size)))
                    if variant:
                        doc = int(words.doc[place])
                        new[begin + doc].add((int(windows.keys[w].view(np.int64)), variant))
                        start = place - int(words.first[doc])
                        old_ranges[begin + doc] = old_ranges[begin + doc] + [{"first": start, "last": start + size}]
        columns = list(batch.columns)
        listed = [[{"key": k, "variant": v} for k, v in sorted(x)] for x in new]
        columns[place_windows] = pa.array(listed, batch.schema.field(place_windows).type)
        merged = [[{"first": a, "last": b} for a, b in _merged([(r["first"], r["last"]) for r in x])] for x in old_ranges]
        columns[place_ranges] = pa.array(merged, batch.schema.field(place_ranges).type)
        columns[batch.schema.get_field_index("n_words")] = pa.array(counts, pa.int64())
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_batches(docs, make, docs.schema)


def _hits(docs: DataFrame, windows: DataFrame, max_windows: int) -> DataFrame:
    """``docs`` with ``n_words``, ``windows`` (those found, sorted) and ``ranges``."""
    spark = importable(docs.sparkSession)
    n_blocks = max(1, -(-windows.count() // max_windows))
    none = "array<struct<first:bigint,last:bigint>>"
    docs = docs.withColumns(
        {"n_words": F.lit(0).cast("bigint"), "windows": F.array().cast(FOUND), "ranges": F.array().cast(none)}
    )
    for block in range(n_blocks):
        rows = windows.where(F.pmod("key", F.lit(n_blocks)) == block).collect()  # about max_windows
        by_size = {size: _Index([r for r in rows if r.size == size]) for size in {r.size for r in rows}}
        docs = _scan_block(docs if not block else stored(docs, "decontaminated"), spark.sparkContext.broadcast(by_size))
    return docs


def _with_items(found: DataFrame, listed: DataFrame, windows: DataFrame) -> DataFrame:
    """``found`` (a stored table) with ``items`` in place of ``windows``."""
    dirty = found.where(F.size("windows") > 0)
    sets = dirty.select("windows").distinct().withColumn("of", F.col("windows"))
    single = sets.select("of", F.explode("windows").alias("w")).select("of", "w.key", "w.variant")
    named = single.join(windows, ["key", "variant"]).join(listed, ["key", "size", "words"])
    by_set = named.groupBy("of").agg(F.sort_array(F.collect_set("item")).alias("items"))
    columns = [*(c for c in found.columns if c not in ("windows", "items")), "items"]
    clean = found.where(F.size("windows") == 0).withColumn("items", F.array().cast("array<string>"))
    return clean.select(columns).unionByName(dirty.drop("items").join(by_set, F.col("windows") == F.col("of")).select(columns))


def _windows(items: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    listed = stored(item_windows(items, n), "item-windows")
    return listed, stored(distinct_windows(listed), "windows")


def scan(docs: DataFrame, items: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` (any columns, one of them ``text``) with ``n_words``, ``items`` (ids of the items found, sorted as strings)
    and ``ranges`` (word ranges covered by windows, merged, end exclusive). Columns of these names are replaced.

    ``items``: id and text, in this order.
    """
    listed, windows = _windows(items, n)
    hits = stored(_hits(boxed(docs), windows, max_windows), "hits")
    own = [F.col(f"doc.{c}").alias(c) for c in docs.columns if c not in ("n_words", "items", "ranges")]
    return _with_items(hits, listed, windows).select(*own, "n_words", "items", "ranges")


def ranges(docs: DataFrame, items: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``(doc, text, n_words, ranges)``: whole rows of ``docs`` in ``doc``; which items were found isn't looked up."""
    return _hits(boxed(docs), _windows(items, n)[1], max_windows).drop("windows")


def n_hit() -> F.Column:
    """Words covered by windows, from ``ranges``."""
    return F.aggregate("ranges", F.lit(0).cast("bigint"), lambda total, r: total + r["last"] - r["first"])


def clean_documents(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """Documents without any hit, with their own columns."""
    return ranges(docs, items, **how).where(F.size("ranges") == 0).select("doc.*")


def cut_spans(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """All documents; covered words, and what stands between them, are cut out of ``text``."""
    found = ranges(docs, items, **how)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        texts, ranges = batch.column(at), batch.column(batch.schema.get_field_index("ranges")).to_pylist()
        cut = texts.to_pylist()
        for i in (i for i, r in enumerate(ranges) if r):
            words, raw, kept, done = Words(texts.slice(i, 1), ALNUM, hashed=False), cut[i].encode(), [], 0
            for r in ranges[i]:
                kept.append(raw[done : words.starts[r["first"]]])
                done = words.ends[r["last"] - 1]
            cut[i] = b"".join([*kept, raw[done:]]).decode()
        columns = [pa.array(cut, pa.string()) if k == at else c for k, c in enumerate(batch.columns)]
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    cut = map_batches(found, make, found.schema)
    return cut.select(*["text" if c == "text" else F.col(f"doc.{c}") for c in docs.columns])


def report(docs: DataFrame, items: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per document, in the form of the registered query."""
    listed, windows = _windows(items, n)
    hits = stored(_hits(docs.select("doc_id", "text"), windows, max_windows).drop("text"), "hits")
    found = _with_items(hits, listed, windows)
    joined = F.array_join("items", ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(joined, 256).alias("items_sha256"),
        (F.size("ranges") > 0).alias("contaminated"),
    )
