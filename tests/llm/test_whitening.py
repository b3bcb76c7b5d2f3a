"""Whitening against an eigendecomposition of the covariance in memory."""

import math

import numpy as np
import pytest

from lexigram.llm import whitening

SCHEMA = "vec_id bigint, embedding array<double>, component int, n int"


def brute(rows):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n = len(x)
    sums = [sum(col) for col in zip(*x)]
    dev = np.array([[n * a - s for a, s in zip(row, sums)] for row in x], object)
    centred = (dev / n).astype(float)
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)
    return [int((d**2).sum()) for d in dev], centred @ axes[:, order] / np.sqrt(e[order]), e[order] / e.sum()


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(300, 10)) @ rng.normal(size=(10, 10)) * 3
    a[200:] = a[200]  # a third are one vector
    return [(i, [float(c) for c in r]) for i, r in enumerate(a)]


def test_against_eigenvectors(spark, rows):
    first = rows[0][1][1:]
    unusable = [(900, None), (901, [None, *first]), (902, [math.nan, *first]), (903, [math.inf, *first]), (904, []), (905, [1.0]),
                (906, [1e300, *first])]
    got = {(r.vec_id, r.component): r for r in whitening.report(table(spark, rows + unusable)).collect()}
    deviations, whitened, explained = brute(rows)
    assert len(got) == len(rows) * 10
    for k in range(10):
        sign = np.sign(got[0, k + 1].whitened * whitened[0, k])
        for i in range(len(rows)):
            r = got[i, k + 1]
            assert (r.n, r.deviation) == (len(rows), deviations[i]) and r.identity_error < 1e-9
            assert sign * r.whitened == pytest.approx(whitened[i, k], abs=1e-7)
            assert r.explained == pytest.approx(explained[k], rel=1e-9)


def test_badly_conditioned_columns(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(400, 1)) * 1e6
    a = np.hstack([base, base + rng.integers(-1, 2, size=(400, 1)), rng.normal(size=(400, 2))])
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(a)]
    got = whitening.report(table(spark, rows)).collect()
    _, _, explained = brute(rows)
    assert len(got) == 1600 and got[0].identity_error < 1e-6
    assert [r.explained for r in sorted(got, key=lambda r: (r.vec_id, r.component))[:3]] == pytest.approx(explained[:3], rel=1e-6)


def test_columns_without_variance_give_no_component(spark, rows):
    wider = [(i, [*v, v[0], 7.0]) for i, v in rows]
    got = whitening.report(table(spark, wider)).collect()
    assert {r.component for r in got} == set(range(1, 11)) and got[0].identity_error < 1e-9


def test_at_most_so_many_components(spark, rows):
    assert {r.component for r in whitening.report(table(spark, rows), components=3).collect()} == {1, 2, 3}


def test_equal_vectors_one_vector_and_empty(spark):
    assert whitening.report(table(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    assert whitening.report(table(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_deviations_beyond_64_bits_are_null(spark):
    got = whitening.report(table(spark, [(i, [float(i) * 1e9, 1.0 * (i % 2)]) for i in range(9)])).collect()
    want, *_ = brute([(i, [float(i) * 1e9, 1.0 * (i % 2)]) for i in range(9)])
    for r in got:
        assert r.deviation == (want[r.vec_id] if want[r.vec_id] < 2**63 else None)
