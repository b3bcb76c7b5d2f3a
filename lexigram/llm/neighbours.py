"""Approximate nearest neighbours by inner product over balanced posting lists.

*Lists.* Vectors get one more component that brings all to the largest length, so the largest inner product is the smallest
distance. Centroids are fitted on the driver to a bounded sample (``SAMPLE`` vectors with the smallest hash of their id, less
where that is over ``SAMPLE_BYTES``; at least four for each centroid): k-means
in which clusters that grow too large are split and tiny ones dropped. About ``LIST_SIZE`` vectors belong to a centroid, up to
``MAX_LISTS`` centroids. Every vector is indexed: it joins the list of its nearest centroid and, near a boundary, of up to
``REPLICAS`` centroids within ``BOUNDARY`` times that distance. Lists are dealt into shards of about ``SHARD_ROWS`` rows; a
longer list gets several shards.

*Graph.* Centroids are linked to their nearest centroids and some far ones. A search starts at fixed entry points and widens
from every centroid within the asked ratio of the best distance so far, and from the nearest ``WIDTH``, until none is left.

*Search.* A query selects the ``LEAST_LISTS`` nearest lists and all whose centroid is within ``RATIO`` times the distance of the
nearest one, and is sent once to every shard with such lists. Shards score in blocks of queries, and pass on the best
``k + 1`` distinct vectors of each query with inner products recomputed in double precision.

Equal vectors are one entry; its ``k + 1`` smallest ids are enough for any answer, ties going to smaller ids. Null ids, vectors
that are null, zero, of another length than most or that hold null or non-finite components take no part. Rows that share
the query's id are not its neighbours; an id that repeats is listed once, at its best score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigram.llm.common import importable, map_batches
from lexigram.session import stored

K = 20
SAMPLE, SAMPLE_BYTES, LIST_SIZE, MAX_LISTS = 40_000, 64 << 20, 128, 8_192
BOUNDARY, REPLICAS = 1.1, 4
RATIO, LEAST_LISTS = 1.15, 8
LINKS, FAR_LINKS, ENTRIES, WIDTH = 16, 4, 32, 16
SHARD_ROWS, QUERY_BLOCK = 16_384, 4_096


def valid(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vec, dim, square)`` of ``vectors`` (id, array): components as little-endian doubles."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, rows = [], []
        for name, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = vector.values
            if name is None or values is None or not len(values) or values.null_count:
                continue
            x = values.to_numpy(zero_copy_only=False).astype("<f8")
            if np.isfinite(x).all() and x.any():
                ids.append(name)
                rows.append(x)
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([x.tobytes() for x in rows], pa.binary()),
            pa.array([len(x) for x in rows], pa.int32()),
            pa.array([float(x @ x) for x in rows], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["vec_id", "vec", "dim", "square"])

    rows = vectors.select(F.col(vectors.columns[0]).cast("bigint"), vectors.columns[1])
    return map_batches(rows, make, "vec_id bigint, vec binary, dim int, square double")


def _matrix(column) -> np.ndarray:
    raw = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(x[a : a + 4096], centres).argmin(1) for a in range(0, len(x), 4096)])


def fit_centroids(x: np.ndarray, n: int, turns: int = 8) -> np.ndarray:
    """About ``n`` centres of a sample; clusters of over twice the mean size are split, those under an eighth dropped."""
    random = np.random.default_rng(0)
    n = max(1, min(n, len(x)))
    centres = x[random.choice(len(x), n, replace=False)]
    for turn in range(turns):
        near = _nearest(x, centres)
        sizes = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        mean = len(x) / n
        kept = sizes >= max(1, mean / 8)
        centres = sums[kept] / sizes[kept][:, None]
        if turn < turns - 1:
            large = np.flatnonzero(sizes > 2 * mean)
            extra = [x[random.choice(np.flatnonzero(near == c), 1)] for c in large]
            centres = np.concatenate([centres, *extra])
    return centres


@dataclass
class Graph:
    """Centroids and their links."""

    centres: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    longest: float

    @classmethod
    def build(cls, centres: np.ndarray, longest: float) -> Graph:
        n, random = len(centres), np.random.default_rng(1)
        links = np.zeros((n, min(LINKS, n) + FAR_LINKS), np.int64)
        links[:, -FAR_LINKS:] = random.integers(0, n, (n, FAR_LINKS))
        for a in range(0, n, 1024):
            d = _distances(centres[a : a + 1024], centres)
            links[a : a + 1024, :-FAR_LINKS] = np.argpartition(d, min(LINKS, n) - 1, axis=1)[:, : min(LINKS, n)]
        return cls(centres, links, random.choice(n, min(ENTRIES, n), replace=False), longest)

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with the component that makes distances fall as inner products rise; queries at length one get 0."""
        if query:
            x = x * (self.longest / np.sqrt((x * x).sum(1)))[:, None]
            return np.column_stack([x, np.zeros(len(x))])
        rest = np.sqrt(np.maximum(0, self.longest**2 - (x * x).sum(1)))
        return np.column_stack([x, rest])

    @staticmethod
    def _bound(distance: np.ndarray, ratio: float) -> float:
        width = min(WIDTH, len(distance)) - 1
        nearest = np.partition(distance, width)[: width + 1]
        return max(nearest.min() * ratio, nearest[np.isfinite(nearest)].max())

    def within(self, point: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Centroids found within ``ratio`` times the least distance, and the nearest ``WIDTH`` at least; nearest first, with
        their distances."""
        distance = np.full(len(self.centres), np.inf)
        opened = np.zeros(len(self.centres), bool)
        new = self.entries
        while len(new):
            gap = self.centres[new] - point
            distance[new] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            bound = self._bound(distance, ratio)
            wave = np.flatnonzero((distance <= bound) & ~opened)
            if not len(wave):
                break
            opened[wave] = True
            reached = np.zeros(len(distance), bool)
            reached[self.links[wave].ravel()] = True
            new = np.flatnonzero(reached & np.isinf(distance))
            if not len(new):
                new = wave[:0]
                if ((distance <= bound) & ~opened).any():
                    continue
        found = np.flatnonzero(distance <= self._bound(distance, ratio))
        order = found[np.argsort(distance[found], kind="stable")]
        return order, distance[order]


def postings(entries: DataFrame, graph) -> DataFrame:
    """``(list, entry, vec)``: every entry in its nearest list and, near a boundary, in further ones."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        g, lists, rows = graph.value, [], []
        for row, point in enumerate(g.lifted(_matrix(batch.column(1)))):
            order, distance = g.within(point, BOUNDARY)
            taken = order[distance <= BOUNDARY * distance[0]][:REPLICAS]
            lists += taken.tolist()
            rows += [row] * len(taken)
        chosen = batch.take(pa.array(rows, pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *chosen.columns], names=["list", "entry", "vec"])

    return map_batches(entries.select("entry", "vec"), make, "list int, entry bigint, vec binary")


def deal_lists(sizes: dict[int, int], shard_rows: int = SHARD_ROWS) -> dict[int, list[int]]:
    """Shards of each list: small lists share one, a list larger than a shard gets several."""
    shards: dict[int, list[int]] = {}
    shard, room = -1, 0
    for c in sorted(sizes):
        if sizes[c] > shard_rows:
            parts = -(-sizes[c] // shard_rows)
            shards[c] = list(range(shard + 1, shard + 1 + parts))
            shard, room = shard + parts, 0
            continue
        if sizes[c] > room:
            shard, room = shard + 1, shard_rows
        shards[c] = [shard]
        room -= sizes[c]
    return shards


def _route(queries: DataFrame, graph, shards: dict[int, list[int]], blocks: int) -> DataFrame:
    """``(shard, block, query_id, vec, lists)``: every query once for each shard that holds selected lists."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        g, names, where, chosen = graph.value, [], [], []
        for row, point in enumerate(g.lifted(_matrix(batch.column(1)), query=True)):
            order, distance = g.within(point, RATIO)
            order = order[(distance <= RATIO * distance[0]) | (np.arange(len(order)) < LEAST_LISTS)]
            by_shard: dict[int, list[int]] = {}
            for c in order.tolist():
                for s in shards.get(c, ()):
                    by_shard.setdefault(s, []).append(c)
            for s, lists in by_shard.items():
                where.append(s)
                names.append(row)
                chosen.append(np.array(lists, "<i4").tobytes())
        taken = batch.take(pa.array(names, pa.int32()))
        columns = [pa.array(where, pa.int32()), *taken.columns, pa.array(chosen, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "query_id", "vec", "lists"])

    routed = map_batches(queries.select("query_id", "vec"), make, "shard int, query_id bigint, vec binary, lists binary")
    return routed.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))


def _search(k: int):
    """Best ``k + 1`` entries per query of one shard."""

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "entry": [], "score": []}
        if len(rows) and len(queries):
            rows = rows.sort_values(["entry", "list"], ignore_index=True)
            entries, first = np.unique(rows["entry"].to_numpy(), return_index=True)
            vectors, lists = _matrix(rows["vec"].iloc[first]), rows["list"].to_numpy()
            asked, names = _matrix(queries["vec"]), queries["query_id"].tolist()
            selected = [np.frombuffer(x, "<i4") for x in queries["lists"]]
            chosen = np.zeros(int(max(lists.max(), max(x.max() for x in selected))) + 1, bool)
            for begin in range(0, len(asked), 128):
                rough = asked[begin : begin + 128] @ vectors.T
                for at in range(begin, begin + len(rough)):
                    chosen[selected[at]] = True
                    held = np.flatnonzero(np.logical_or.reduceat(chosen[lists], first))
                    chosen[selected[at]] = False
                    near = rough[at - begin, held]
                    if len(held) > 2 * k:
                        held = held[np.argpartition(-near, 2 * k)[: 2 * k + 1]]
                    score = (vectors[held] * asked[at]).sum(1)
                    order = np.lexsort((entries[held], -score))[: k + 1]
                    out["query_id"] += [names[at]] * len(order)
                    out["entry"] += entries[held[order]].tolist()
                    out["score"] += score[order].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "entry": "int64", "score": "float64"})

    return run


def search(vectors: DataFrame, is_query: F.Column, k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every row of ``vectors`` (vec_id, array) that
    ``is_query`` (a condition on ``vec_id``) holds for."""
    spark = importable(vectors.sparkSession)
    rows = stored(valid(vectors), "vectors")
    dims = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("square")).orderBy(F.desc("n"), "dim").first()
    rows = rows.where(F.col("dim") == (dims["dim"] if dims else 0)).select("vec_id", "vec")
    longest = float(np.sqrt(dims["square"])) if dims else 1.0

    same = Window.partitionBy("vec").orderBy("vec_id")
    distinct = rows.distinct()
    numbered = distinct.select("vec_id", "vec", F.row_number().over(same).alias("place"), F.first("vec_id").over(same).alias("entry"))
    members = stored(numbered.where(F.col("place") <= k + 1), "members")
    entries = members.where("place = 1").select("entry", "vec")
    n = entries.count()

    width = dims["dim"] if dims else 1
    n_sample = min(SAMPLE, max(64, SAMPLE_BYTES // (8 * width)))
    sample = entries.orderBy(F.xxhash64("entry"), "entry").limit(n_sample).select("vec").toArrow().column(0)
    plain = _matrix(sample) if n else np.zeros((1, width))
    points = Graph(plain, plain, plain, longest).lifted(plain)
    n_lists = min(MAX_LISTS, max(1, len(plain) // 4), -(-max(1, n) // LIST_SIZE))
    graph = spark.sparkContext.broadcast(Graph.build(fit_centroids(points, n_lists), longest))

    held = stored(postings(entries, graph), "postings")
    sizes = {r["list"]: r["n"] for r in held.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most MAX_LISTS
    shards = deal_lists(sizes)
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vec").distinct()
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    routed = _route(queries, graph, shards, blocks)

    table = spark.createDataFrame([(c, s[0], len(s)) for c, s in shards.items()], "list int, first int, parts int")
    part = F.col("first") + F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int")
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    dealt = held.join(F.broadcast(table), "list").select(part.alias("shard"), block, "list", "entry", "vec")  # MAX_LISTS rows
    keys = ["shard", "block"]
    found = dealt.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInPandas(
        _search(k), "query_id bigint, entry bigint, score double"
    )

    best = found.groupBy("query_id", "entry").agg(F.max("score").alias("score"))
    by_entry = Window.partitionBy("query_id").orderBy(F.desc("score"), "entry")
    best = best.withColumn("place", F.row_number().over(by_entry)).where(F.col("place") <= k + 1).drop("place")
    named = best.join(members.select("entry", "vec_id"), "entry").where("vec_id != query_id")
    named = named.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_row = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = named.withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def report(vectors: DataFrame) -> DataFrame:
    return search(vectors, F.col("vec_id") % 20 == 0)
