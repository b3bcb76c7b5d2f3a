import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lexigram.llm import components as c
from lexigram.llm import minhash as m
from tests.llm.test_words import NOT_BLANK, lower


def shingles(text):
    ws = NOT_BLANK.findall(lower(text))
    return {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set()


def brute(rows):
    """Smallest id reachable, for every id."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, x) in enumerate(sets):
        for j, y in sets[k + 1 :]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def changed(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**9)}"
    return words


def corpus(seed=5):
    """A hub with copies that are like it but not like each other, a chain, exact copies, a shared passage, odd cases."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    hub = [word() for _ in range(120)]
    texts = [" ".join(hub)] + [" ".join(changed(hub, 3, rng)) for _ in range(60)]
    chain = [word() for _ in range(150)]
    for k in range(12):
        texts.append(" ".join(chain))
        chain[12 * k : 12 * k + 4] = [word() for _ in range(4)]
    texts += ["Same  text\nhere, with more words than five", "same text here, WITH more words than five"] * 15
    passage = [word() for _ in range(40)]
    texts += [" ".join(passage + [word() for _ in range(rng.randrange(5, 60))]) for _ in range(60)]
    texts += ["", None, " ", "a", "A", "a b", "a b", "b a", "x " * 5000 + "end"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_components_against_brute_force(docs, monkeypatch):
    rows = corpus()
    want = brute(rows)
    for block, dense in ((512, 2), (8, 0)):  # whole buckets and pairs; many blocks, all dense
        monkeypatch.setattr(m, "BLOCK", block)
        monkeypatch.setattr(m, "DENSE", dense)
        got = m.report(docs(*rows)).collect()
        assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(rows)
        assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t)) for i, t in rows}
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def dealt(spark, comps, keys=(7,)):
    """Blocks of buckets that all hold the members ``i`` in component ``comps[i]``."""
    rows = [(k, band, i, c) for band, k in enumerate(keys) for i, c in enumerate(comps)]
    members = spark.createDataFrame(rows, "key bigint, band int, doc bigint, comp bigint")
    items = spark.range(len(comps)).selectExpr("id as doc", "id as n", "binary('s') as sketch")
    return m._blocked(members, items).collect()


def met_pairs(rows):
    blocks = defaultdict(list)
    for r in rows:
        blocks[r.key, r.part_a, r.part_b].append(r)
    return Counter(
        (a.doc, b.doc)
        for (_, x, y), found in blocks.items()
        for a in found
        for b in found
        if a.doc < b.doc and a.comp != b.comp and (x == y or a.part != b.part)
    )


def test_a_host_enters_once_however_many_buckets_hold_it(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 8)
    comps = [0] * 100 + [1, 2, 2, *range(300, 306)]
    rows = dealt(spark, comps, keys=range(40))
    assert len([r for r in rows if r.comp == 0]) == 100 * 2  # nine guests are two parts
    pairs = {(i, j) for j in range(len(comps)) for i in range(j) if comps[i] != comps[j]}
    assert met_pairs(rows).keys() == pairs
    single = dealt(spark, [5, 6], keys=range(40))  # two documents that meet everywhere
    assert met_pairs(single).keys() == {(0, 1)} and len(single) == 2


def test_shards_and_copies_of_a_hot_bucket_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 8)
    monkeypatch.setattr(m, "SHARD", 256)
    rows = dealt(spark, range(400))  # 400 components: every member meets all others
    assert max(Counter(r.shard for r in rows).values()) < 4 * m.SHARD
    rows = dealt(spark, [0] * 999 + [1])  # settled but for one member
    assert len(rows) < 1200
    comps = [0] * 60 + [1] * 30 + [2] * 5 + [3, 4, 5, 5]
    met = met_pairs(dealt(spark, comps))
    pairs = {(i, j) for j in range(len(comps)) for i in range(j) if comps[i] != comps[j]}
    assert met == dict.fromkeys(pairs, 1)


def test_bands_miss_a_pair_at_the_threshold_once_in_millions():
    assert (1 - (m.PERCENT / 100) ** m.ROWS) ** m.BANDS < 3e-7


def test_repeated_and_null_ids(docs):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (None, "u v w x y z"), (3, "a b c d e f"), (4, "q"), (4, "q")]
    got = m.report(docs(*rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4)]
    left = m.one_per_class(docs(*rows))
    assert left.columns == docs((1, "")).columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 1, 4]
    assert m.report(docs((1, "")).limit(0)).count() == 0


def test_sketches_estimate_similarity_and_always_fill():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    sets = [a[:600], a[150:750], a[:1], a[:0]]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    got = m.sketches(np.concatenate(sets), first)
    empty = 2**64 - 1
    assert (got[:3] != empty).all() and (got[3] == empty).all()
    assert (got[0] == got[1]).mean() == pytest.approx(450 / 750, abs=0.15)
    again = m.sketches(a[:600][::-1].copy(), np.array([0, 600]))
    assert np.array_equal(again[0], got[0])


def test_shingle_sets_have_the_size_of_brute_force():
    texts = [t for _, t in corpus(6)]
    hashes, first = m.shingle_sets(pa.array(texts, pa.string()))
    assert np.diff(first).tolist() == [len(shingles(t)) for t in texts]


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    links = spark.createDataFrame(path + path[:3], "a bigint, b bigint")
    got = {r.node: r.component for r in c.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert c.components(links.limit(0)).count() == 0
