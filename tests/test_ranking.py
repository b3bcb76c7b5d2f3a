"""Places within groups, and free places, against sorting in memory."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lexigram.operators import next_word as next_word_operators
from lexigram.operators.next_word import unseen_top_k
from lexigram.operators.ranking import first_free, numbered
from lexigram.plans import next_word

ROWS = [("hot", i, (i * 7919) % 997) for i in range(1500)] + [((None, "a", "b", "c")[i % 4], i, i % 13) for i in range(3000)]


@pytest.fixture
def hot(spark):
    """A third of all rows under one key."""
    return spark.createDataFrame(ROWS, "k string, i int, v int").repartition(7)


def test_places_and_sizes(hot):
    groups = defaultdict(list)
    for k, i, v in ROWS:
        groups[k].append((-v, i))
    want = {(k, i): (p, len(g)) for k, g in groups.items() for p, (_, i) in enumerate(sorted(g), 1)}
    got = numbered(hot, ["k"], [F.col("v").desc(), "i"], "place", "n").collect()
    assert len(got) == len(ROWS) and {(r.k, r.i): (r.place, r.n) for r in got} == want


def test_no_window_takes_a_whole_key(hot):
    out = numbered(hot, ["k"], [F.col("v").desc(), "i"], "place")
    windows = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "row_number()" in x]
    assert windows and all("__part" in x for x in windows)


def test_a_hot_key_spans_ranges(spark, hot):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else a few rows make one partition
    try:
        out = numbered(hot, ["k"], [F.col("v").desc(), "i"], "place").withColumn("at", F.spark_partition_id())
        assert out.where("k = 'hot'").select("at").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ties_repeats_and_empty(spark):
    same = spark.createDataFrame([("a", 1)] * 40, "k string, v int").repartition(5)
    assert sorted(r.p for r in numbered(same, ["k"], ["v"], "p").collect()) == list(range(1, 41))
    assert numbered(same.where("k = 'none'"), ["k"], ["v"], "p", "n").count() == 0


def test_free_places(spark):
    held = {"a": [1, 2, 4, 7], "b": [2, 3], "c": [p for p in range(1, 900) if p % 300], "d": [9]}
    rows = spark.createDataFrame([(k, p) for k, ps in held.items() for p in ps], "k string, p bigint")
    got = defaultdict(list)
    for r in first_free(rows, ["k"], "p", 3).collect():
        got[r.k].append(r.p)
    assert {k: sorted(v) for k, v in got.items()} == {"a": [3, 5, 6], "b": [1, 4, 5], "c": [300, 600, 900], "d": [1, 2, 3]}


def test_unseen_words_against_all_candidates(spark, trigrams):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(9)]
    counts = defaultdict(int)
    for _ in range(120):
        counts[" ".join(rng.choices(words, range(9, 0, -1), k=3))] += rng.randint(1, 4)
    table = trigrams(counts)
    got = defaultdict(list)
    for r in unseen_top_k(table, 4).orderBy("rank").collect():
        got[r.w1, r.w2].append((r.w3, r.prob))
    from lexigram.operators.next_word import score_requests

    prefixes = {tuple(g.split()[:2]) for g in counts}
    vocabulary = {w for g in counts for w in g.split()}
    asked = spark.createDataFrame([(a, b, w) for a, b in prefixes for w in vocabulary], "w1 string, w2 string, w3 string")
    want = defaultdict(list)
    for r in score_requests(asked, table).where("not seen").collect():
        want[r.w1, r.w2].append((-r.prob, r.w3))
    want = {k: [(w, pytest.approx(-p)) for p, w in sorted(v)[:4]] for k, v in want.items()}
    assert got == want


def test_ranks_of_next_words(trigrams):
    table = trigrams({"a b c": 5, "a b d": 9, "a b e": 5, "x y z": 1})
    from lexigram.operators.next_word import with_rank

    rows = with_rank(next_word.probabilities(table)).collect()
    assert {(r.w1, r.w3): r["rank"] for r in rows} == {("a", "d"): 1, ("a", "c"): 2, ("a", "e"): 3, ("x", "z"): 1}


def test_unseen_words_are_not_ranked_again_per_prefix(trigrams):
    table = trigrams({"a b c": 4, "b c a": 1, "a b a": 2, "b a b": 3, "c c c": 1})
    plan = unseen_top_k(table, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" not in plan and "Union" not in plan


@pytest.mark.parametrize("bits", [4, 6, 62])
def test_places_beyond_the_bits_are_found_too(spark, trigrams, monkeypatch, bits):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(14)]
    counts = defaultdict(int)
    for _ in range(500):
        counts[" ".join(rng.choices(words, range(14, 0, -1), k=3))] += 1
    want = sorted(unseen_top_k(trigrams(counts), 3).collect())
    table = spark.createDataFrame([(*g.split(), 1) for g, n in counts.items() for _ in range(n)], "w1 string, w2 string, w3 string, n bigint")
    monkeypatch.setattr(next_word_operators, "BITS", bits)
    assert sorted(unseen_top_k(table, 3).collect()) == want  # and trigrams that were not counted


def test_prefixes_bring_one_row_to_their_list(trigrams):
    table = trigrams({"a b c": 4, "b c a": 1, "a b a": 2, "b a b": 3, "c c c": 1})
    plan = unseen_top_k(table, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode") < plan.index("Join")  # places are taken apart after the join
