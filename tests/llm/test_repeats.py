"""Removed passages against a table of all windows in memory."""

import hashlib
import random

import numpy as np
import pytest

from lexigram.llm import repeats

SCHEMA = "doc_id bigint, text string"


def brute(rows):
    low = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - 49 if d is not None else 0):
            w = raw[i : i + 50]
            low[w] = min(low.get(w, d), d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - 49 if d is not None else 0):
            if low[raw[i : i + 50]] < d:
                gone[i : i + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return in_order(out)


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéü") for _ in range(rng.randrange(1, 7))) for _ in range(40)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    stock = [prose(25) for _ in range(5)]
    out = []
    for i in range(400):
        text, r = prose(rng.randrange(80)), rng.random()
        if r < 0.35:  # a third of all documents share one passage
            text = f"{text} {stock[0]} {prose(5)}"
        elif r < 0.5:
            text = rng.choice(stock)[rng.randrange(40) :] + prose(10)
        elif r < 0.6 and out:
            text = rng.choice(out)[1]
        elif r < 0.7 and out:
            old = rng.choice(out)[1] or ""
            k = rng.randrange(len(old) + 1)
            text = old[:k] + "X" + old[k + 1 :]
        elif r < 0.73:
            text = "a" * rng.randrange(300)
        elif r < 0.75:
            text = None
        out.append(((None, 37, i * 37)[i % 3] if i % 20 == 0 else i * 37, text))
    return [*out, (99_999, prose(30_000) + stock[1])]


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_against_all_windows(spark, rows, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as pack", "'x' as bytes", "2 as anchor").repartition(3)
        got = in_order(tuple(r) for r in repeats.report(table).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got == brute(rows) and sum(r[2] for r in got) > 10_000


def test_small_ranges_and_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(repeats, "RANGE", 200)
    monkeypatch.setattr(repeats, "SHARD", 2_000)
    monkeypatch.setattr(repeats, "PACK", 64)
    assert in_order(tuple(r) for r in repeats.report(spark.createDataFrame(rows, SCHEMA)).collect()) == brute(rows)


def test_edges(spark):
    fifty = "".join(chr(97 + i % 26) for i in range(50))
    few = [(1, fifty), (2, fifty), (3, fifty[:49]), (4, "x" + fifty + fifty), (5, ""), (6, None), (7, fifty[1:] + "!"), (2, fifty)]
    assert in_order(tuple(r) for r in repeats.report(spark.createDataFrame(few, SCHEMA)).collect()) == brute(few)
    assert repeats.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equal_hashes_of_different_fragments_stay_apart(monkeypatch):
    monkeypatch.setattr(repeats, "mix", lambda x: np.zeros_like(x))
    rows = np.array([[1] * repeats.LONGEST, [2] * repeats.LONGEST, [1] * repeats.LONGEST], np.uint8)
    assert repeats._alike(rows, np.full(3, repeats.LONGEST)).tolist() == [0, 1, 0]


def test_codes_round_trip():
    values = np.sort(np.random.default_rng(0).integers(0, 2**48, 500))
    assert repeats._decoded(repeats._coded(values)).tolist() == values.tolist()
