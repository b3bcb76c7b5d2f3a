"""Merkle manifest against hashing in memory."""

import hashlib
import random
import zlib

import pytest

from lexigram.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for proof, a in zip(proofs, at):
            first = a // 3 * 3
            run = nodes[first : first + 3]
            proof.append(("".join(run[: a - first]), "".join(run[a - first + 1 :])))
        at = [a // 3 for a in at]
        nodes = [digest(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], proofs


def brute(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0], leaf(r)))
        below[s] = (own, *tree([leaf(r) for r in own]))
    root, above = tree([below[s][1] for s in sources])
    out = []
    for s, upper in zip(sources, above):
        own, sub, proofs = below[s]
        for row, proof in zip(own, proofs):
            path, seen = proof + upper, row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                seen = (*row[:4], row[4].replace("\n", ""))
            at = leaf(seen)
            for before, after in path:
                at = digest(before, at, after)
            out.append((row[0], leaf(row), sub, root, digest(*[b + a for b, a in path]), at, at == root))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def documents(n):
    rng = random.Random(n)
    source = lambda i: rng.choice(["hot"] * 6 + ["b", "ü", None, "", f"z{i % 40}"])
    text = lambda: rng.choice([None, "", "x\ny", "line", "é\n" * 3])
    return [(None if i % 97 == 5 else i, source(i), rng.choice(["en", None]), i, text()) for i in range(n)]


@pytest.mark.parametrize("n", [1, 4, 700])
def test_against_hashing_in_memory(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = documents(n)
    rows += rows[:3]  # repeated rows and ids
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as tree", "'y' as node", "1 as place").repartition(3)
    got = [tuple(r) for r in merkle.report(table).collect()]
    assert in_order(got) == in_order(brute(rows))
    if n == 700:
        assert {r[6] for r in got} == {True, False}


def test_whole_blocks(spark):
    rows = [(i, "one", "en", i, f"t\n{i}" * (40_000 if i == 7 else 1)) for i in range(800)]
    got = [tuple(r) for r in merkle.report(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert in_order(got) == in_order(brute(rows))


def test_empty(spark):
    assert merkle.report(spark.createDataFrame([], SCHEMA)).collect() == []
