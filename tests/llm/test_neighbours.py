import numpy as np
import pytest

from lexigram.llm import neighbours as n

VECTORS = "vec_id bigint, embedding array<double>"


def brute(ids, x, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(1)
        out[int(ids[i])] = [int(ids[j]) for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
    return out


def clustered(count=1500, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, count)] + 0.4 * rng.normal(size=(count, dim))
    return x * rng.uniform(0.5, 2, (count, 1))  # lengths differ: inner products aren't distances


@pytest.mark.parametrize("small_shards", [False, True])
def test_recall_order_and_scores(spark, monkeypatch, small_shards):
    if small_shards:
        monkeypatch.setattr(n, "SHARD_ROWS", 60)
        monkeypatch.setattr(n, "QUERY_BLOCK", 30)
    x = clustered()
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS)
    want, got = brute(np.arange(len(x)), x), {}
    for r in n.report(table.selectExpr("vec_id", "embedding", "1 as score")).collect():
        got.setdefault(r.query_id, {})[r.rank] = r
    assert got.keys() == want.keys()
    hits = 0
    for query, rows in got.items():
        assert sorted(rows) == list(range(1, 21))
        scores = [rows[k].score for k in range(1, 21)]
        assert scores == sorted(scores, reverse=True)
        assert all(r.score == pytest.approx((x[r.vec_id] * x[query]).sum(), rel=1e-12) for r in rows.values())
        hits += len({r.vec_id for r in rows.values()} & set(want[query]))
    assert hits >= 0.9 * 20 * len(want)


def test_equal_vectors_ties_and_unusable_rows(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(300)]
    rows += [(1000 + i, [float(np.cos(i)), float(np.sin(i)), i / 50]) for i in range(100)]
    rows += [(5000, None), (5020, [0.0, 0.0, 0.0]), (5040, [float("nan"), 1.0, 1.0]), (5060, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(20, [1.0, 0.0, 0.0]), (5080, [1.0, None, 2.0]), (5100, [])]
    got = n.report(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.query_id for r in got} == {*range(0, 300, 20), *range(1000, 1100, 20)}
    at = lambda q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
    assert at(40) == list(range(20)) and at(0) == list(range(1, 21))
    assert all(r.vec_id < 5000 for r in got)


def test_few_rows(spark):
    some = lambda *rows: n.report(spark.createDataFrame(list(rows), VECTORS)).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in some((20, [1.0, 2.0]), (3, [3.0, 0.0]))] == [(20, 1, 3, 3.0)]
    assert some((20, [1.0])) == [] and some((1, [1.0]), (2, [1.0])) == [] and some((20, None)) == []
    assert n.report(spark.createDataFrame([], VECTORS)).count() == 0


def test_lists_are_dealt_evenly():
    shards = n.deal_lists({0: 10, 1: 95, 2: 350, 3: 5, 4: 60}, 100)
    assert len(shards[2]) == 4 and not set(shards[2]) & {s for c in (0, 1, 3, 4) for s in shards[c]}
    assert shards[0] != shards[1]


def test_graph_search_finds_what_a_scan_finds():
    centres = np.random.default_rng(1).normal(size=(600, 8))
    graph, hits, total = n.Graph.build(centres, 1.0), 0, 0
    for point in np.random.default_rng(2).normal(size=(50, 8)):
        d = np.sqrt(((centres - point) ** 2).sum(1))
        want = set(np.flatnonzero(d <= 1.15 * d.min()).tolist()) | set(np.argsort(d)[: n.WIDTH].tolist())
        hits, total = hits + len(want & set(graph.within(point, 1.15)[0].tolist())), total + len(want)
    assert hits >= 0.95 * total
