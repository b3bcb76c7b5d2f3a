"""What the physical plans look like, and results when one key holds a third of all rows."""

import re
import time
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lexigram.functions.scoring import significant
from lexigram.operators import counts as ct
from lexigram.operators import next_word as nw
from lexigram.operators.similarity import _with_norms
from lexigram.plans import next_word
from lexigram.plans.registry import QUERIES
from lexigram.session import apply_settings, broadcast_if_small, scratch_dir, spread, stored
from lexigram.sources.text import counted_grams, ngram_occurrences, trigram_words, trigrams_from_text

#: Queries whose result is one plan over the tables; the others read back what a stream or a sink has written.
WRITTEN = {"rejected_messages", "sequence_file_counts", "labelled_csv"}
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in WRITTEN)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The executed plan; subqueries inside it still show their initial plans, without code generation marks."""
    df.collect()
    return plan(df).split("\n+- == Initial Plan ==")[0]


@contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_rows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas|FlatMapGroups", text)


def test_text_is_read_and_counted_once(spark, sf_dir):
    text = final_plan(QUERIES["next_word_prob"](spark, sf_dir))
    assert "ReadSchema: struct<text:string>" in text
    assert len(re.findall(r"\*\(\d+\) Generate inline\(arrays_zip", text)) == 1
    assert text.count("ReusedExchange") >= 4


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["corpus_subset"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in text


def test_top_k_limits_groups_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["next_word_topk"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2


def test_plan_time_estimates_never_broadcast(spark, sf_dir):
    assert "BroadcastHashJoin" not in plan(QUERIES["next_word_prob"](spark, sf_dir))


def test_broadcast_depends_on_the_measured_size(spark):
    big = spark.range(1000).select(F.col("id").cast("string").alias("w1"))
    hinted = lambda side: "BroadcastHashJoin" in plan(big.join(side, "w1", "left_semi"))
    words = stored(big.limit(10), "words")
    apply_settings(spark)
    assert hinted(broadcast_if_small(words)) and not hinted(broadcast_if_small(words, max_bytes=50))
    assert not hinted(words)


def test_spread_leaves_well_split_input_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert spread(wide) is wide
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() > 1


def test_scratch_folder_follows_the_setting(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir")) and first != second


def test_without_the_setting_the_shared_warehouse_holds_scratch():
    class Cluster:
        class conf:
            get = staticmethod({"spark.sql.warehouse.dir": "hdfs://store/warehouse"}.get)

    assert scratch_dir(Cluster, "x").startswith("hdfs://store/warehouse/scratch/x-")


#: Small enough thresholds for adaptive execution to split a partition of a test table.
SPLIT = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_words_are_split_where_lists_and_norms_join(spark):
    hot = spark.range(40_000).select(
        F.concat(F.lit("w"), "id").alias("w1"),
        F.when(F.col("id") % 3 == 0, "the").otherwise(F.concat(F.lit("v"), "id")).alias("w2"),
        F.concat(F.lit("x"), "id").alias("w3"),
        F.lit(1).cast("bigint").alias("n"),
    )
    table = stored(hot.repartition(8), "hot")
    stop = stored(spark.createDataFrame([("the",), ("v1",)], "word string"), "stop").distinct()
    pairs = stored(hot.select(F.col("w2").alias("w1"), F.col("w3").alias("w2")).repartition(8), "pairs")
    norms = stored(spark.range(3000).select(F.when(F.col("id") == 0, "the").otherwise(F.concat(F.lit("v"), "id")).alias("lexeme")), "n")
    norms = norms.groupBy("lexeme").agg(F.count(F.lit(1)).alias("size"))
    with settings(spark, **SPLIT):
        kept = ct.drop_stopwords(table, stop)
        assert final_plan(kept).count("skew=true") >= 1 and kept.count() == 40_000 - 13_334 - 1
        sized = _with_norms(pairs, norms)
        assert final_plan(sized).count("skew=true") >= 1 and sized.where("w1 = 'the'").count() == 13_334


def test_stopword_filter_counts_the_text_once(spark, sf_dir):
    text = final_plan(QUERIES["stopword_filter"](spark, sf_dir))
    assert len(re.findall(r"\*\(\d+\) Generate inline\(arrays_zip", text)) == 1


def test_small_probabilities_keep_order_and_digits(spark):
    rows = [("a", "b", f"w{i}", 1e-10 * (i + 1) / 7) for i in range(6)] + [("a", "b", "z", 0.123456789876), ("a", "b", "y", 1.0)]
    probs = spark.createDataFrame(rows, "w1 string, w2 string, w3 string, prob double")
    best = nw.top_k(probs, 4).withColumn("prob", significant(F.col("prob"))).orderBy("rank").collect()
    assert [r.w3 for r in best] == ["y", "z", "w5", "w4"]
    assert [r.prob for r in best] == pytest.approx([1.0, 0.12345679, 8.57142857e-11, 7.14285714e-11], rel=1e-9)


def test_hot_prefix_and_hot_word(spark):
    """A third of the trigrams share one prefix and another third one middle word; skewed partitions are split."""
    rows = [("of", "the", f"w{i}", i % 5 + 1) for i in range(20_000)]
    rows += [(f"w{i}", "the", "end", 2) for i in range(20_000)]
    rows += [(f"u{i % 300}", f"v{i % 700}", f"x{i}", 1) for i in range(20_000)]
    table = stored(spark.createDataFrame(rows, "w1 string, w2 string, w3 string, n bigint").repartition(8), "hot")
    bi, uni = Counter(), Counter()
    for a, b, c, n in rows:
        bi[a, b] += n
        bi[b, c] += n
        for w in (a, b, c):
            uni[w] += n
    with settings(spark, **SPLIT):
        stats = nw.trigram_stats(table)
        got = {(r.w1, r.w2, r.w3): (r.n, r.c12, r.c23, r.c2, r.c3) for r in stats.collect()}
        assert final_plan(stats).count("skew=true") == 4
        want = {(a, b, c): (n, bi[a, b], bi[b, c], uni[b], uni[c]) for a, b, c, n in rows}
        assert got == want
        best = nw.top_k(next_word.probabilities(table), 3).where("w1 = 'of' and w2 = 'the'").orderBy("rank").collect()
        assert [(r.rank, r.w3) for r in best] == [(1, "w10004"), (2, "w10009"), (3, "w10014")]
        ordered = [r.w3 for r in next_word.ranked(table).where("w1 = 'of'").collect()]
        assert len(ordered) == 20_000 and ordered[:3] == ["w10004", "w10009", "w10014"]
    assert ct.unigram_totals(ct.pair_roles(table)).where("word = 'the'").first()["n"] == uni["the"]


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getPath() for i in range(files.length()) if files.apply(i).getName().endswith(".data")}


def test_a_written_step_leaves_no_shuffle(spark):
    before = _shuffle_files(spark)
    table = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sevenths")
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before and table.count() == 7


def test_steps_give_the_same_statistics(spark, trigrams):
    table = trigrams({"a b c": 4, "b c a": 1, "a b a": 2, "b a b": 3, "c c c": 1})
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(next_word.stats_in_steps(table)) == rows(nw.trigram_stats(table))
    assert rows(next_word.probabilities_in_steps(table)) == rows(next_word.probabilities(table))


def test_trigram_words_count_each_place(spark):
    docs = spark.createDataFrame([("a b a c",), ("the",), ("x y",), ("",), (None,), ("a b c",)], "text string")
    counted = ct.unigram_totals(ct.pair_roles(trigrams_from_text(docs)))
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(trigram_words(docs)) == rows(counted) == [("a", 4), ("b", 3), ("c", 2)]


def test_counted_grams_equal_counted_trigrams(spark):
    docs = spark.createDataFrame([("a b a b a",), ("b a b",), ("été über naïve",)], "text string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(counted_grams(ngram_occurrences(docs, 3))) == rows(trigrams_from_text(docs))


@pytest.mark.parametrize("name", ["stopword_filter", "stopword_filter_from_file"])
def test_stopwords_are_dropped_before_the_count(spark, sf_dir, name):
    text = final_plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"hashpartitioning\(w[123]#", text) and "hashpartitioning(gram#" in text
    assert re.search(r"BroadcastHashJoin.*Generate inline\(arrays_zip", text, re.S)
