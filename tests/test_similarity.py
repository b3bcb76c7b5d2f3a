import math
import random

import pytest
from pyspark.sql import functions as F
from test_dependency import LINES
from test_dependency import brute as counted

from lexigram.operators import similarity as sim
from lexigram.plans import similarity
from lexigram.session import stored
from lexigram.sources.lists import gold_pairs, gold_vocabulary

VECTORS = "lexeme string, feature string, a1 double, a2 double, a3 double, a4 double"


def brute(v1, v2):
    """c1 .. c24 from the definitions, over the union of both vectors' features."""
    columns = {}
    for m in range(4):
        cells = [(v1.get(f, [0.0] * 4)[m], v2.get(f, [0.0] * 4)[m]) for f in v1.keys() | v2.keys()]
        total = lambda fn: math.fsum(fn(a, b) for a, b in cells)

        def js(a, b):
            if a + b == 0:
                return 0.0
            ratios = [(x, 2 * x / (a + b)) for x in (a, b)]
            return sum(x * math.log2(r) for x, r in ratios if r > 0)

        norm = math.sqrt(total(lambda a, b: a * a)) * math.sqrt(total(lambda a, b: b * b))
        low, high, both = total(min), total(max), total(lambda a, b: a + b)
        columns[f"c{m + 1}"] = total(lambda a, b: abs(a - b))
        columns[f"c{m + 5}"] = math.sqrt(total(lambda a, b: (a - b) ** 2))
        columns[f"c{m + 9}"] = total(lambda a, b: a * b) / norm if norm > 0 else -1.0
        columns[f"c{m + 13}"] = low / high if high > 0 else -1.0
        columns[f"c{m + 17}"] = 2 * low / both if both > 0 else -1.0
        columns[f"c{m + 21}"] = total(js)
    return columns


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(7)
    words = {}
    for word, size in (("a", 40), ("b", 25), ("c", 3), ("d", 1), ("hub", 120)):
        features = rng.sample(range(150), size)
        words[word] = {
            f"f{f}": [float(rng.randint(1, 50)), rng.random(), rng.uniform(-3, 6), rng.uniform(-1, 1)] for f in features
        }
    words["twin"] = dict(words["a"])
    words["low"] = {f: [1.0, 0.1, -2.0, -0.5] for f in list(words["a"])[:5]}
    words["cold"] = {"only": [1.0, 0.1, -2.0, -0.5]}
    words["zero"] = {"only0": [0.0, 0.0, 0.0, 0.0]}
    return words


PAIRS = [
    ("a", "b"), ("b", "a"), ("a", "twin"), ("a", "a"), ("c", "hub"), ("hub", "d"), ("a", "none"), ("none", "a"),
    ("none", "nothing"), ("low", "a"), ("low", "low"), ("cold", "none"), ("cold", "low"), ("zero", "none"), ("zero", "a"),
]


def test_distances_equal_their_definitions(spark, vectors):
    rows = [(w, f, *map(float, v)) for w, fs in vectors.items() for f, v in fs.items()]
    table = stored(spark.createDataFrame(rows, VECTORS), "vectors")
    pairs = spark.createDataFrame(PAIRS, "w1 string, w2 string")
    got = {(r.w1, r.w2): r.asDict() for r in sim.distances(sim.pair_sums(table, pairs)).collect()}
    assert got.keys() == {p for p in PAIRS if p != ("none", "nothing")}
    for (w1, w2), row in got.items():
        want = brute(vectors.get(w1, {}), vectors.get(w2, {}))
        for name, value in want.items():
            assert row[name] == pytest.approx(value, rel=1e-9, abs=1e-9), (w1, w2, name)
        assert all(-1 - 1e-9 <= row[f"c{i}"] <= 1 + 1e-9 for i in range(9, 13))
        assert row["c13"] <= row["c17"] + 1e-12 and row["c14"] <= row["c18"] + 1e-12
    for i in (*range(1, 9), *range(21, 25)):
        assert got["a", "twin"][f"c{i}"] == pytest.approx(0, abs=1e-9)
    assert [got["a", "twin"][f"c{i}"] for i in range(5, 9)] == [0.0] * 4


def test_outer_vectors_give_the_same_sums(spark, vectors):
    rows = [(w, f, *map(float, v)) for w, fs in vectors.items() for f, v in fs.items()]
    table = spark.createDataFrame(rows, VECTORS)
    pairs = spark.createDataFrame(PAIRS, "w1 string, w2 string")
    cells = sim.pair_vectors(sim.pair_features(table, pairs))
    totals = cells.groupBy("w1", "w2").agg(F.sum("x1").alias("x"), F.sum("y1").alias("y"))
    outer = {(r.w1, r.w2): (r.x, r.y) for r in totals.collect()}
    for (w1, w2), (x, y) in outer.items():
        assert x == sum(v[0] for v in vectors.get(w1, {}).values())
        assert y == sum(v[0] for v in vectors.get(w2, {}).values())
    assert len(outer) == len(PAIRS) - 1


def test_one_sided_pair_of_the_dependency_lines(lines):
    lexemes, pairs, features = counted(LINES)
    all_lines, all_features = lexemes.total(), pairs.total()
    own = {f: n for (l, f), n in pairs.items() if l == "cat"}
    assert own and not any(l == "ax" for l, _ in pairs)
    gold = lines("axe\tcats\t1", "axes\tcat\t0", "houses\tcat\t0")
    rows = {(r.w1, r.w2): r for r in similarity.labelled_matrix(lines(*LINES), gold).collect()}
    assert set(rows) == {("ax", "cat"), ("hous", "cat")}
    row, n_l = rows["ax", "cat"], lexemes["cat"]
    assert row.c1 == sum(own.values()) and row.c5 == pytest.approx(math.sqrt(sum(n * n for n in own.values())))
    assert row.c2 == pytest.approx(sum(n / n_l for n in own.values())) and row.c21 == pytest.approx(row.c1)
    pmi = [math.log2(n * all_features / (n_l * features[f])) for f, n in own.items()]
    assert row.c3 == pytest.approx(sum(map(abs, pmi)))
    expected = {f: n_l / all_lines * features[f] / all_features for f in own}
    t_test = [(n / all_lines - expected[f]) / math.sqrt(expected[f]) for f, n in own.items()]
    assert row.c8 == pytest.approx(math.sqrt(sum(t * t for t in t_test)))
    assert [row[f"c{i}"] for i in range(9, 13)] == [-1.0] * 4
    for i in (13, 14, 17, 18):  # shared part over all parts
        assert row[f"c{i}"] == 0.0
    assert (row.result, rows["hous", "cat"].result) == ("1", "0")
    other = {f: n for (l, f), n in pairs.items() if l == "hous"}
    assert set(own) & set(other)
    assert rows["hous", "cat"].c1 == sum(abs(own.get(f, 0) - other.get(f, 0)) for f in own | other)


def test_gold_pairs(lines):
    gold = gold_pairs(lines("Cats\tdogs\tFalse", "Cat\tdog\tTrue", "dog\tcat\tFalse", "broken"))
    assert {tuple(r) for r in gold.collect()} == {("Cat", "dog", "True"), ("dog", "cat", "False")}
    assert {r.lexeme for r in gold_vocabulary(gold).collect()} == {"Cat", "dog", "cat"}
    assert gold_pairs(lines("cats\tdogs\tx"), stem=False).first()["w1"] == "cats"


def test_missing_label_is_null(spark):
    matrix = spark.createDataFrame([("a", "b", 1.0), ("c", "d", 2.0)], "w1 string, w2 string, c1 double")
    gold = spark.createDataFrame([("a", "b", "1")], "w1 string, w2 string, label string")
    assert {r.w1: r.result for r in sim.labelled(matrix, gold).collect()} == {"a": "1", "c": None}


def test_cells_are_formed_where_the_vectors_lie(spark, vectors):
    rows = [(w, f, *map(float, v)) for w, fs in vectors.items() for f, v in fs.items()]
    table = spark.createDataFrame(rows, VECTORS)
    pairs = spark.createDataFrame(PAIRS, "w1 string, w2 string")
    plain = sim.pair_vectors(sim.pair_features(table, pairs))
    dealt = sim.pair_vectors(sim.pair_features(table.repartition("feature"), F.broadcast(pairs)))
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_lines_are_parsed_once(spark, lines):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def met(line):
        seen.add(1)
        return line

    pairs = stored(gold_pairs(lines("cat\thous\t1", "cat\tcat\t0"), stem=False), "gold")
    text = lines(*LINES).select(met("value").alias("value"))
    got = similarity.gold_vectors(text, pairs, stem=False)
    assert {r.lexeme for r in got.collect()} == {"cat"} and seen.value == len(LINES)


def test_vectors_are_dealt_by_the_rows_that_pairs_make_of_them(spark, monkeypatch):
    vectors = stored(spark.range(60).select(F.lit("hub").alias("lexeme"), F.col("id").cast("string").alias("feature"), *[F.rand(1).alias(a) for a in sim.VALUES]), "vectors")
    pairs = spark.range(40).select(F.lit("hub").alias("w1"), F.concat(F.lit("w"), "id").alias("w2"))
    whole = sim.pair_vectors(sim.pair_features(vectors, F.broadcast(pairs)))
    monkeypatch.setattr(sim, "CELLS", 100)
    dealt = sim.dealt_by_feature(vectors, pairs)
    assert dealt.rdd.getNumPartitions() == 25  # 60 features in 40 pairs
    cells = sim.pair_vectors(sim.pair_features(dealt, F.broadcast(pairs)))
    assert sorted(cells.collect()) == sorted(whole.collect())
    assert max(r.n for r in cells.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()) <= 400
    plan = cells._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
