"""Dependency lines against a brute-force reading of them."""

import math
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexigram.operators import cooccurrence as co
from lexigram.sources import dependency as dep

LINES = """\
cats\tblack/JJ/amod/2 cats/NNS/ROOT/0 walking/VBG/acl/2\t12\t1988,5\t1990,7
cat\tthe/DT/det/2 cat/NN/ROOT/0 walks/VBZ/dep/2\t30
cat\tcat/NN/ROOT/0 of/IN/prep/1 houses/NNS/pobj/2\t9
houses\tblack/JJ/amod/2 houses/NNS/ROOT/0\t7
house\twalking/VBG/acl/2 house/NN/ROOT/0 black/JJ/amod/2\t21
house\tblack/JJ/amod/3 and/CC/cc/1 house/NN/conj/1\t4""".split("\n")

#: Stems of the words above that differ from the word.
STEMS = {"cats": "cat", "walking": "walk", "walks": "walk", "houses": "hous", "house": "hous"}


def brute(lines):
    """Totals per lexeme, per (lexeme, feature) and per feature."""
    stem = lambda w: STEMS.get(w, w)
    lexemes, pairs, features = Counter(), Counter(), Counter()
    for line in lines:
        head, arcs, total = line.split("\t")[:3]
        parsed = [a.split("/") for a in arcs.split(" ")]
        root = next((i + 1 for i, a in enumerate(parsed) if a[3] == "0"), None)
        lexemes[stem(head)] += int(total)
        for word, _, kind, at in parsed:
            if root and int(at) == root:
                feature = f"{stem(word)}-{kind}"
                pairs[stem(head), feature] += int(total)
                features[feature] += int(total)
    return lexemes, pairs, features


@pytest.fixture
def counts(lines):
    return co.cooccurrence(dep.parse_dependency_lines(lines(*LINES)), stem=True)


def test_totals(counts):
    lexemes, pairs, features = brute(LINES)
    assert tuple(co.corpus_totals(counts).first()) == (lexemes.total(), pairs.total())
    assert {r.lexeme: r.count_l for r in co.lexeme_totals(counts).collect()} == lexemes
    got = {(r.lexeme, r.feature): (r.count_lf, r.count_l) for r in co.pair_totals_with_lexeme(counts).collect()}
    assert got == {k: (n, lexemes[k[0]]) for k, n in pairs.items()}
    assert {r.feature: r.count_f for r in co.feature_totals(counts).collect()} == features
    assert pairs["cat", "walk-acl"] == 12 and pairs["hous", "black-amod"] == 28 and "conj" not in str(pairs)


def test_association_measures(spark, counts):
    lexemes, pairs, features = brute(LINES)
    l, f = lexemes.total(), pairs.total()
    got = {(r.lexeme, r.feature): r for r in co.associations(counts).collect()}
    assert got.keys() == pairs.keys()
    for key, n in pairs.items():
        nl, nf, row = lexemes[key[0]], features[key[1]], got[key]
        assert (row.a1, row.a2) == (n, n / nl)
        assert row.a3 == pytest.approx(math.log2(n * f / (nl * nf)), rel=1e-12, abs=1e-12)
        assert row.a4 == pytest.approx((n / l - nl / l * nf / f) / math.sqrt(nl / l * nf / f), rel=1e-9, abs=1e-12)
    vocabulary = spark.createDataFrame([("hous",)], "lexeme string")
    cut = {(r.lexeme, r.feature): r for r in co.associations(counts, vocabulary).collect()}
    assert cut == {k: v for k, v in got.items() if k[0] == "hous"}


def test_large_counts_do_not_overflow(lines):
    big = 4_000_000_000_000
    rows = [f"h\th/X/ROOT/0 f/X/d/1\t{big}", f"g\tg/X/ROOT/0 f/X/d/1\t{big}"]
    got = co.associations(co.cooccurrence(dep.parse_dependency_lines(lines(*rows)))).collect()
    assert [(r.a1, r.a3) for r in got] == [(big, 0.0), (big, 0.0)]


def test_irregular_lines(lines):
    rows = [
        "1two\ta/X/d/0\t5",
        "\ta/X/d/0\t5",
        "few\tfew/X/ROOT/0",
        "count\tcount/X/ROOT/0\tmany",
        "word\tword/X/ROOT/0 bad/X/d/x\t7",
        "word\tword/X/ROOT/0 short/X/d\t7",
        "rootless\ta/X/d/2 b/X/d/1\t11",
        "good\t,/X/punct/9z good/X/ROOT/0 late/X/mod/2 '/X/punct/2 far/X/mod/3\t3",
        "two\ttwo/X/ROOT/0 other/X/ROOT/0 f/X/d/1 g/X/d/2\t2",
    ]
    parsed = dep.parse_dependency_lines(lines(*rows)).cache()
    assert {r.line: r.reason for r in dep.rejected_dependency_lines(parsed).collect()} == {
        rows[0]: "head does not start with a letter",
        rows[1]: "head does not start with a letter",
        rows[2]: "fewer than 3 fields or no count",
        rows[3]: "fewer than 3 fields or no count",
        rows[4]: "bad head index",
        rows[5]: "bad head index",
    }
    assert {r.line.split("\t")[0]: r.root for r in co.roots(parsed).collect()} == {"rootless": 0, "good": 2, "two": 1}
    got = sorted(tuple(r) for r in co.features(parsed).collect())
    assert got == [("good", "late-mod", 3), ("two", "f-d", 2)]
    assert dep.dependency_rows(parsed).count() == 3
    counts = co.cooccurrence(parsed)
    assert tuple(co.corpus_totals(counts).first()) == (16, 5)
    assert {r.lexeme: r.count_l for r in co.lexeme_totals(counts).collect()} == {"rootless": 11, "good": 3, "two": 2}


def test_words_that_share_a_stem_fall_together(lines):
    rows = ["cats\tcats/X/ROOT/0 runs/X/d/1\t2", "cat\tcat/X/ROOT/0 running/X/d/1\t3"]
    parsed = dep.parse_dependency_lines(lines(*rows))
    assert [tuple(r) for r in co.pair_totals(co.cooccurrence(parsed, stem=True)).collect()] == [("cat", "run-d", 5)]
    assert co.pair_totals(co.cooccurrence(parsed)).count() == 2
    assert sorted(tuple(r) for r in co.features(parsed, stem=True).collect()) == [("cat", "run-d", 2), ("cat", "run-d", 3)]


def test_sums_need_no_counts(lines, counts):
    rows = co.contributions(dep.parse_dependency_lines(lines(*LINES)), stem=True)
    assert co.corpus_totals(rows).first() == co.corpus_totals(counts).first()
    assert sorted(co.feature_totals(rows).collect()) == sorted(co.feature_totals(counts).collect())
    plan = co.corpus_totals(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_other_lexemes_are_counted_together(spark, lines, counts):
    vocabulary = spark.createDataFrame([("hous",), ("none",), ("hous",)], "lexeme string")
    cut = co.cooccurrence(dep.parse_dependency_lines(lines(*LINES)), stem=True, vocabulary=vocabulary)
    assert {r.lexeme for r in cut.collect()} == {"hous", None}
    assert co.corpus_totals(cut).first() == co.corpus_totals(counts).first()
    listed = vocabulary.distinct()
    assert sorted(co.associations(cut, listed).collect()) == sorted(co.associations(counts, listed).collect())


def test_head_index_is_what_a_cast_takes(spark):
    texts = ["2", " 2", "2 ", "\t2", "+2", "-2", "\x002", "2\x7f", "  +2  ", "2.5", "2.", "1e3", "２", "2x", "x", "2147483647", "2147483648", "", "--2", "+ 2", "\x852", "٣", "2\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r for r in rows.select("t", dep._index(F.col("t")).alias("got"), F.col("t").try_cast("int").alias("want")).collect() if r.got != r.want] == []


def test_bad_head_indexes_cost_no_exceptions(spark):
    def seconds(head):
        arcs = " ".join(f"w{i}/X/d/{head}" for i in range(60))
        rows = spark.range(0, 8000, 1, 8).select(F.concat(F.lit(f"a\t{arcs}\t"), F.col("id").cast("string")).alias("value"))
        took = []
        for _ in range(4):
            start = time.time()
            dep.parse_dependency_lines(rows).write.format("noop").mode("overwrite").save()
            took.append(time.time() - start)
        return min(took)

    seconds("2")  # compiles the code
    assert seconds("x") < 2 * seconds("2")


def test_letters_are_told_without_the_pattern(spark):
    texts = ["a", "z", "A", "Z", "{", "[", "@", "`", "é", "Ж", "中", "1", "", ",", None, "zebra", "Ünder", "́a", "_a"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", dep._starts_with_letter(F.col("t")).alias("got"), F.col("t").rlike(dep.STARTS_WITH_LETTER).alias("want"))
    assert [r for r in got.collect() if r.got != r.want] == []


def test_arcs_are_looked_through_for_roots_and_bad_indexes_in_one_pass(lines):
    parsed = dep.parse_dependency_lines(lines(*LINES))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "exists(" not in plan and plan.count("transform(") == 3
    rows = co.contributions(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert rows.count("transform(") == 3  # what hangs on the root is not written anew
