import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexigram.functions.scoring import interpolated
from lexigram.operators import counts as ct
from lexigram.operators import next_word as nw
from lexigram.plans import next_word
from lexigram.sources.text import ngram_occurrences, trigrams_from_text

CORPUS = {"a b c": 4, "a b d": 2, "b c a": 3, "x a b": 5, "a b a": 2, "b b b": 1}


def probability(n3, n2, n1, pair, word, corpus):
    k = lambda n: (math.log(n + 1) + 1) / (math.log(n + 1) + 2)
    share = lambda a, b: a / b if b else 0.0
    k3, k2 = k(n3), k(n2)
    return k3 * share(n3, pair) + (1 - k3) * k2 * share(n2, word) + (1 - k3) * (1 - k2) * share(n1, corpus)


def brute(counts):
    tri = {tuple(g.split()): n for g, n in counts.items()}
    bi, uni = Counter(), Counter()
    for (a, b, c), n in tri.items():
        bi[a, b] += n
        bi[b, c] += n
        for w in (a, b, c):
            uni[w] += n
    return tri, bi, uni


def test_formula_on_stored_values(spark):
    values = spark.range(1).select(
        interpolated(*[F.lit(v).cast("bigint") for v in (0, 48, 87, 0, 48, 6579)], guarded=True).alias("p")
    )
    assert values.first()["p"] == pytest.approx(0.41625880832553647, abs=1e-15)


def test_totals_and_probabilities(trigrams):
    table = trigrams(CORPUS)
    tri, bi, uni = brute(CORPUS)
    roles = ct.pair_roles(table)
    assert {(r.w1, r.w2): r.n for r in ct.bigram_totals(roles).collect()} == dict(bi)
    assert {r.word: r.n for r in ct.unigram_totals(roles).collect()} == dict(uni)
    c0 = sum(uni.values())
    assert ct.corpus_size(ct.unigram_totals(roles)).first()["c0"] == c0 == 3 * sum(tri.values())
    assert ct.corpus_size_direct(table).first()["c0"] == c0
    for guarded in (False, True):
        got = {(r.w1, r.w2, r.w3): r.prob for r in next_word.probabilities(table, guarded).collect()}
        want = {g: probability(n, bi[g[1:]], uni[g[2]], bi[g[:2]], uni[g[1]], c0) for g, n in tri.items()}
        assert got.keys() == want.keys()
        assert all(got[g] == pytest.approx(want[g], rel=1e-12) and got[g] > 0 for g in want)


def test_trigrams_never_outweigh_their_first_pair(spark, sf_dir):
    from lexigram.plans import stand_ins

    stats = nw.trigram_stats(stand_ins.trigrams(spark, sf_dir))
    heavy = stats.groupBy("w1", "w2").agg(F.sum("n").alias("n"), F.max("c12").alias("c12")).where("n > c12")
    assert heavy.count() == 0


def test_pairs_that_concatenate_alike_stay_apart(trigrams):
    got = ct.bigram_totals(ct.pair_roles(trigrams({"ab c x": 1, "a bc x": 2}))).collect()
    assert {(r.w1, r.w2): r.n for r in got} == {("ab", "c"): 1, ("c", "x"): 1, ("a", "bc"): 2, ("bc", "x"): 2}


def test_equal_probabilities_are_all_kept_in_word_order(trigrams):
    table = trigrams({f"p q {w}": 1 for w in ("e", "d", "c")} | {"p q z": 9, "a b c": 1})
    rows = next_word.ranked(table).collect()
    assert [(r.w1, r.w2, r.w3) for r in rows][0] == ("a", "b", "c")
    assert [r.w3 for r in rows if r.w1 == "p"] == ["z", "c", "d", "e"]
    best = next_word.best(table, 2).where("w1 = 'p'").orderBy("rank").collect()
    assert [(r.rank, r.w3) for r in best] == [(1, "z"), (2, "c")]


def test_unseen_scores_cover_every_unseen_candidate(trigrams):
    tri, bi, uni = brute(CORPUS)
    c0 = sum(uni.values())
    got = {(r.w2, r.w3): r for r in nw.unseen_scores(trigrams(CORPUS)).collect()}
    assert got.keys() == bi.keys()
    for (w2, w3), row in got.items():
        unseen = [w1 for w1 in uni if (w1, w2, w3) not in tri]
        assert row.unseen == len(unseen)
        assert row.prob == pytest.approx(probability(0, bi[w2, w3], uni[w3], 0, uni[w2], c0), rel=1e-12)


def test_requests_mix_seen_unseen_and_unknown(spark, trigrams):
    tri, bi, uni = brute(CORPUS)
    asked = [("a", "b", "c"), ("x", "b", "c"), ("q", "q", "a"), ("q", "q", "q"), ("a", "b", "x"), ("a", "b", "c")]
    requests = spark.createDataFrame(asked, "w1 string, w2 string, w3 string")
    got = {(r.w1, r.w2, r.w3): r for r in nw.score_requests(requests, trigrams(CORPUS)).collect()}
    assert got.keys() == set(asked)
    for g, row in got.items():
        want = probability(tri.get(g, 0), bi[g[1:]], uni[g[2]], bi[g[:2]], uni[g[1]], sum(uni.values()))
        assert row.seen == (g in tri) and row.prob == pytest.approx(want, rel=1e-12)


def test_stopwords_drop_a_trigram_in_any_place(spark, trigrams):
    stop = spark.createDataFrame([("the",), ("of",)], "word string")
    table = trigrams({"the b c": 1, "a of c": 1, "a b the": 1, "a b c": 1})
    for words in (stop, F.broadcast(stop)):
        assert [tuple(r) for r in ct.drop_stopwords(table, words).collect()] == [("a", "b", "c", 1)]


def test_text_becomes_trigrams(spark):
    docs = spark.createDataFrame([("One, two  THREE two-one",), ("a b",), ("",), (None,), ("été où là",)], "text string")
    got = {(r.w1, r.w2, r.w3): r.n for r in trigrams_from_text(docs).collect()}
    assert got == {
        ("one", "two", "three"): 1, ("two", "three", "two"): 1, ("three", "two", "one"): 1, ("été", "où", "là"): 1,
    }
    assert ngram_occurrences(docs, 2).count() == 4 + 1 + 2


def test_zero_weight_trigrams_are_dropped(spark):
    rows = spark.createDataFrame(
        [("a", "b", "c", 1999, 0), ("a", "b", "d", 1999, 2), ("a", "b", "d", 2000, 3)],
        "w1 string, w2 string, w3 string, year int, match_count bigint",
    )
    assert [tuple(r) for r in ct.trigram_totals(rows).collect()] == [("a", "b", "d", 5)]
