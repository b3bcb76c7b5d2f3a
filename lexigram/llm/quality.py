"""Quality classifier: a generalised additive model with pairwise interactions over surface statistics of whole texts.

*Learning.* Every feature is cut into at most ``BINS`` quantile bins. Cyclic boosting goes through the features in turn, again
and again: each step fits a tree of three leaves to the gradient of the logistic loss over one feature's bins and adds a small
part of it to that feature's lookup table. Then the pairs of features with the largest gain over what the tables explain get
tables of their own, boosted in the same cyclic way with one cut per axis.

*Scoring.* Bin numbers index the tables; the score is the logistic function of the sum.

The model is fitted on the driver over a bounded sample: the ``MAX_TRAIN`` labelled documents with the smallest hash of
their id. Text statistics and scores are computed by Spark over all documents. A document with several labels counts with
their mean, ties as 1; null labels and labels of unknown documents are left out. Null texts are scored like empty ones.
Without labels of both kinds every score is the share of label 1 (0.5 without any label).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigram.llm.common import boxed, importable, map_batches
from lexigram.llm.words import NOT_BLANK, Words, blocks, buffer, doc_runs
from lexigram.session import stored

MAX_TRAIN = 20_000
BINS, PAIR_BINS, PAIRS = 48, 8, 12
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
THRESHOLD = 0.3
#: One document in so many is never learned from.
HELD_OUT = 5

FEATURES = (
    "log_words",
    "word_bytes",
    "line_words",
    "upper",
    "digits",
    "dots_commas",
    "exclamations",
    "bars",
    "symbols",
    "beyond_ascii",
    "blanks",
    "word_end_marks",
    "short_words",
    "repeats_last_word",
    "distinct_words",
    "distinct_pairs",
    "distinct_lines",
    "top_word",
)

_CLASSES = (
    np.arange(65, 91),
    np.arange(48, 58),
    np.array([44, 46]),
    np.array([33]),
    np.array([124]),
    np.array([35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 126]),
    np.arange(128, 256),
    np.array([32, 9, 10, 11, 12, 13]),
)
_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False


def _per_doc(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between neighbouring ``first``."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes per document, and the count of the most frequent one."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    starts = np.flatnonzero(new)
    counts, owner = np.diff(np.append(starts, len(h))), d[starts]
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, counts)
    return np.bincount(owner, minlength=n), top


def measure(text: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    n = len(text)
    raw, offsets = buffer(text)
    words, lines = Words(text, NOT_BLANK), Words(text, _NOT_NEWLINE)
    size, n_words, n_lines = np.diff(offsets), np.diff(words.first), np.diff(lines.first)
    per_byte, per_word = np.maximum(size, 1), np.maximum(n_words, 1)
    classes = []
    for members in _CLASSES:
        table = np.zeros(256, bool)
        table[members] = True
        classes.append(_per_doc(table[raw], offsets) / per_byte)
    length = words.ends - words.starts
    mark = np.zeros(256, bool)
    mark[33:48] = mark[58:65] = mark[91:97] = mark[123:127] = True
    mark[[44, 46]] = False
    places, pairs = doc_runs(words, 2)
    pair_doc = words.doc[places]
    same = np.zeros(len(words.starts), bool)
    same[places] = words.hashes[places] == words.hashes[places + 1]
    distinct, top = _distinct(words.hashes, words.doc, n)
    distinct_pairs, _ = _distinct(pairs, pair_doc, n)
    distinct_lines, _ = _distinct(lines.hashes, lines.doc, n)
    columns = [
        np.log1p(n_words),
        _per_doc(length, words.first) / per_word,
        n_words / np.maximum(n_lines, 1),
        *classes,
        _per_doc(mark[words.data[words.ends - 1]], words.first) / per_word,
        _per_doc(length <= 3, words.first) / per_word,
        _per_doc(same, words.first) / per_word,
        distinct / per_word,
        distinct_pairs / np.maximum(n_words - 1, 1),
        distinct_lines / np.maximum(n_lines, 1),
        top / per_word,
    ]
    return np.column_stack(columns).astype(np.float64)


@dataclass
class Model:
    """Bin edges and lookup tables."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], x[:, k], "right")]
        coarse = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.pair_edges)]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct values near the quantiles, at most ``bins - 1``."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of bins with gradient sums ``g`` and curvature sums ``h``."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _three_leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of a tree with two cuts: the best one, then the better cut of its two sides."""
    cuts = [0, len(g)]
    for _ in range(2):
        found = [(*_best_cut(g[a:b], h[a:b]), a) for a, b in zip(cuts, cuts[1:])]
        gain, at, start = max(found)
        if gain > 0:
            cuts = sorted({*cuts, start + at})
    out = np.empty(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best grid of one cut per axis, over its gain as a whole."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    total_g, total_h = cg[-1, -1], ch[-1, -1]
    rows, cols = np.arange(1, g.shape[0]), np.arange(1, g.shape[1])
    if not len(rows) or not len(cols):
        return 0.0, np.zeros_like(g)

    def parts(c, total):
        a, top, left = c[np.ix_(rows, cols)], c[rows, -1][:, None], c[-1, cols][None, :]
        return a, top - a, left - a, total - top - left + a

    gain = sum(_gain(x, y) for x, y in zip(parts(cg, total_g), parts(ch, total_h))) - _gain(total_g, total_h)
    r, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(g)
    for rows in (slice(0, r + 1), slice(r + 1, None)):
        for cols in (slice(0, c + 1), slice(c + 1, None)):
            out[rows, cols] = _leaf(g[rows, cols].sum(), h[rows, cols].sum())
    return float(gain[r, c]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting over a sample: rows of features, labels 0 or 1."""
    n_features = len(FEATURES)
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        base = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        none = [np.zeros(0)] * n_features
        return Model(base, none, [np.zeros(1)] * n_features, [], none, [])
    base = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    edges = [_edges(x[:, k], BINS) for k in range(n_features)]
    bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    for _ in range(ROUNDS):
        for k in range(n_features):
            g, h = slopes()
            size = len(tables[k])
            step = RATE * _three_leaves(np.bincount(bins[k], g, size), np.bincount(bins[k], h, size))
            tables[k] += step
            total += step[bins[k]]

    pair_edges = [_edges(x[:, k], PAIR_BINS) for k in range(n_features)]
    coarse = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(pair_edges)]

    def grid(i, j):
        g, h = slopes()
        shape = (len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)
        cell = coarse[i] * shape[1] + coarse[j]
        return [np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (g, h)]

    gains = sorted(((_quarters(*grid(i, j))[0], i, j) for i, j in combinations(range(n_features), 2)), reverse=True)
    pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    pair_tables = [np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(pairs, pair_tables):
            step = RATE * _quarters(*grid(i, j))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return Model(base, edges, tables, pairs, pair_edges, pair_tables)


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(HELD_OUT)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> DataFrame:
    """``(y, x)`` of the labelled documents to learn from."""
    chosen = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    mean = chosen.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    known = stored(mean.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labels")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most max_rows ids

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.vstack([measure(batch.column(1).slice(a, b - a)) for a, b in blocks(batch.column(1))])
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], names=["doc_id", "y", "x"])

    measured = map_batches(rows.select("doc_id", "text", "y"), make, "doc_id bigint, y int, x array<double>")
    return measured.groupBy("doc_id").agg(F.min(F.struct("y", "x")).alias("r")).select("doc_id", "r.*")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> Model:
    rows = sorted(training_rows(docs, labels, max_rows).collect(), key=lambda r: r.doc_id)
    x = np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r.y for r in rows], np.float64))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (one column ``text``) with a column ``score``, replaced if there is one."""
    shared = importable(docs.sparkSession).sparkContext.broadcast(model)
    docs = docs.withColumn("score", F.lit(0.0))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column(batch.schema.get_field_index("text"))
        score = np.concatenate([shared.value.score(measure(text.slice(a, b - a))) for a, b in blocks(text)])
        columns = list(batch.columns)
        columns[batch.schema.get_field_index("score")] = pa.array(score)
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_batches(docs, make, docs.schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = scored(docs.select("doc_id", "text"), train(docs, labels))
    return rows.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that are not rejected, with their own columns."""
    return scored(boxed(docs), train(docs, labels)).where(F.col("score") >= THRESHOLD).select("doc.*")
