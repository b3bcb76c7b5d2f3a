"""Whitened principal components of vectors by shifted CholeskyQR.

Each entry ``c`` counts as the whole number ``x = floor(64 * c) + 1000000``. The rows are centred on their exact mean, and are
never held together: a pass over them sums a small Gram matrix.

*Passes.* The first Gram matrix is shifted by a little more than its rounding error, so that its Cholesky factor exists however
badly conditioned the rows are. In the following passes every task runs its rows through the triangular solves of all factors
so far, which brings the columns closer to orthogonal each time, and the Gram matrix of what comes out gives the next factor.
Passes end when that matrix is the identity up to ``CLOSE`` (three passes as a rule). The product of the factors is the R of
the rows' QR decomposition, to double precision, although the rows' own Gram matrix is never decomposed; the singular
values and right vectors of R are those of the rows, so R alone gives the components.

*Rows.* Vectors that are null, empty, hold a null or a non-finite entry, or an entry whose ``x`` is no 64-bit number take no part. Of
vectors of different lengths the most frequent length counts (of equally frequent ones the smallest); the others take no part.
Repeated ids and rows are rows like any other, and null ids stay null. Components without variance (beyond rounding) can't be
whitened and have no rows: one vector, or equal vectors only, give none. ``deviation`` is exact; where it is no 64-bit number it is null.
An empty table gives no rows. Columns beside the id and the vector don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigram.llm.common import importable, release

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
CLOSE = 1e-10
PASSES = 8
EPS = float(np.finfo(np.float64).eps)
#: Rows that a task holds as matrices at a time.
ROWS = 4096


def whole_numbers(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """``(ids, x)`` of the usable rows of one length, each length on its own."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == d)
        entries = vectors.take(pa.array(at)).flatten().cast(pa.float64())
        scaled = SCALE * pc.fill_null(entries, np.nan).to_numpy(zero_copy_only=False).reshape(-1, d)
        with np.errstate(invalid="ignore", over="ignore"):
            good = (np.abs(scaled) < 2.0**62).all(axis=1)
        if good.any():
            yield ids.take(pa.array(at[good])), np.floor(scaled[good]).astype(np.int64) + OFFSET


@dataclass
class Centre:
    """Length, number and exact sums of the rows."""

    d: int
    n: int
    sums: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S`` per entry: 64-bit where that is safe, Python numbers else."""
        bound = self.n * int(np.abs(x).max()) + max(map(abs, self.sums))
        kind = np.int64 if bound < 2**62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def squares(self, dev: np.ndarray) -> pa.Array:
        if dev.dtype == np.int64 and self.d * int(np.abs(dev).max()) ** 2 < 2**63:
            return pa.array((dev * dev).sum(axis=1))
        totals = (dev.astype(object) ** 2).sum(axis=1)
        return pa.array([t if t < 2**63 else None for t in totals], pa.int64())

    def centred(self, dev: np.ndarray) -> np.ndarray:
        return dev.astype(np.float64) / float(self.n)


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of each upper triangular factor in turn."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(len(r)):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            yield from whole_numbers(part.column(0), part.column(1))


def centre(vectors: DataFrame) -> Centre | None:
    """Sums of the rows of each length, summed in two halves so that no sum can overflow; the driver gets one row per length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halves: dict[int, list] = {}
        for _, x in _stretches(batches):
            part = [len(x), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
            old = halves.get(x.shape[1])
            halves[x.shape[1]] = part if old is None else [a + b for a, b in zip(old, part)]
        for d, (n, high, low) in halves.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([v] * d) for v in (d, n)] + [pa.array(range(d), pa.int64()), pa.array(high), pa.array(low)],
                names=["d", "n", "j", "high", "low"],
            )
        release()

    parts = vectors.mapInArrow(run, "d bigint, n bigint, j bigint, high bigint, low bigint")
    exact = F.sum(F.col("high").cast("decimal(38,0)") * F.lit(2**32) + F.col("low"))
    by_entry = parts.groupBy("d", "j").agg(F.sum("n").alias("n"), exact.cast("string").alias("total"))
    lengths = by_entry.where("j = 0").groupBy("d", "n").agg(F.count(F.lit(1))).orderBy(F.desc("n"), "d").limit(1)
    best = by_entry.join(lengths.select(F.col("d").alias("chosen")), F.col("d") == F.col("chosen"))
    rows = sorted(best.select("j", "n", "total", "d").collect())
    return Centre(rows[0].d, rows[0].n, [int(r.total) for r in rows]) if rows else None


def gram(vectors: DataFrame, at: Centre, transform: Callable[[np.ndarray], np.ndarray], d: int) -> tuple[np.ndarray, np.ndarray]:
    """``(sums, gram)`` of the transformed centred rows, from one pass; ``d`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d))
        for _, x in _stretches(batches):
            if x.shape[1] == at.d:
                rows = transform(at.centred(at.deviations(x)))
                total[:d] += rows.T @ rows
                total[d] += rows.sum(axis=0)
        if total.any():
            i, j = np.indices(total.shape).reshape(2, -1)
            keep = (i <= j) | (i == d)
            yield pa.RecordBatch.from_arrays([pa.array(v[keep]) for v in (i, j, total.ravel())], names=["i", "j", "v"])
        release()

    out = np.zeros((d + 1, d))
    for r in vectors.mapInArrow(run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    upper = np.triu(out[:d])
    return out[d], upper + np.triu(upper, 1).T


def _factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of a Gram matrix, shifted as little as it takes."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, EPS * float(np.trace(g)), np.finfo(float).tiny)


def triangular(vectors: DataFrame, at: Centre) -> np.ndarray:
    """R of the centred rows."""
    factors: list[np.ndarray] = []
    for turn in range(PASSES):
        _, g = gram(vectors, at, lambda rows, f=tuple(factors): solved(rows, f), at.d)
        norm = float(np.trace(g))
        if norm == 0:
            return np.zeros((at.d, at.d))
        first = turn == 0
        factors.append(_factor(g, 11 * (at.n * at.d + at.d * (at.d + 1)) * (EPS / 2) * norm if first else 0.0))
        held = np.linalg.eigvalsh(g)
        held = held[held > 0.5]  # directions without variance stay at rounding level
        if turn > 1 and np.abs(held - 1).max(initial=0) < CLOSE:
            break
    r = np.eye(at.d)
    for f in factors:
        r = f @ r
    return r


@dataclass
class Components:
    at: Centre
    axes: np.ndarray  # one column per component
    sigma: np.ndarray
    explained: np.ndarray

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred @ self.axes) * (np.sqrt(self.at.n) / self.sigma)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Components | None:
    """Components of ``(id, vector)``, largest first; None without usable vectors."""
    importable(vectors.sparkSession)
    at = centre(vectors)
    if at is None:
        return None
    _, sigma, axes = np.linalg.svd(triangular(vectors, at))
    total = float((sigma**2).sum())
    kept = np.flatnonzero(sigma > 8 * at.d * EPS * sigma.max(initial=0))[:components]
    return Components(at, axes[kept].T, sigma[kept], sigma[kept] ** 2 / total if total else sigma[kept])


def identity_error(vectors: DataFrame, model: Components) -> float:
    """Largest difference between the covariance of the whitened rows, from a pass of its own, and the identity."""
    k = len(model.sigma)
    sums, g = gram(vectors, model.at, model.whitened, k)
    mean = sums / model.at.n
    return float(np.abs(g / model.at.n - np.outer(mean, mean) - np.eye(k)).max())


def transform(vectors: DataFrame, model: Components, error: float) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every usable row and component."""
    k, at = len(model.sigma), model.at
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _stretches(batches):
            if x.shape[1] != at.d:
                continue
            dev = at.deviations(x)
            owner = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(owner), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, at.n)), at.squares(dev).take(owner),
                    pa.array(model.whitened(at.centred(dev)).ravel()), pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(x) * k, error)),
                ],
                names=names,
            )
        release()

    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    return vectors.mapInArrow(run, schema)


def report(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    vectors = embeddings.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    model = fit(vectors, components)
    if model is None or not len(model.sigma):
        none = Components(Centre(0, 0, []), np.zeros((0, 0)), np.zeros(0), np.zeros(0))
        return transform(vectors.limit(0), none, 0.0)
    return transform(vectors, model, identity_error(vectors, model))
