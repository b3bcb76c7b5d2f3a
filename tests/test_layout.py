"""A model in buckets of its join key."""

from lexigram.operators.next_word import trigram_stats
from lexigram.plans import next_word
from lexigram.plans.layout import write_layout, write_text_layout
from lexigram.sources.text import trigrams_from_text


def test_same_model_without_a_shuffle(spark, trigrams):
    hot = {f"w{i} of the": i % 5 + 1 for i in range(60)}  # one pair holds most rows
    table = trigrams({**hot, "a b c": 3, "b c d": 2, "of the end": 7})
    layout = write_layout(table, buckets=4)
    stats = layout.stats(spark)
    order = lambda rows: sorted(map(tuple, rows.collect()))
    assert order(stats) == order(trigram_stats(table).select(*stats.columns))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    assert order(layout.probabilities(spark)) == order(next_word.probabilities(table))
    buckets = {r.salt for r in spark.table(layout.trigrams).where("w2 = 'of' and w3 = 'the'").select("salt").distinct().collect()}
    assert len(buckets) > 1
    layout.drop(spark)
    assert not spark.catalog.tableExists(layout.trigrams)


def test_only_hot_pairs_are_copied(spark):
    seldom = " ".join(f"r{i} s{i}" for i in range(1500)).translate(str.maketrans("0123456789", "abcdefghij"))
    docs = spark.createDataFrame([("of the end " * 500 + seldom,), (seldom,)], "text string")
    layout = write_text_layout(docs, buckets=4)
    counted = trigrams_from_text(docs)
    order = lambda rows: sorted(map(tuple, rows.collect()))
    stats = layout.stats(spark)
    assert order(stats) == order(trigram_stats(counted).select(*stats.columns))
    copies = {(r.w2, r.w3): r["count"] for r in spark.table(layout.pairs).groupBy("w2", "w3").count().collect()}
    assert copies["of", "the"] == 4 and copies["rh", "sh"] == 1
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    layout.drop(spark)
