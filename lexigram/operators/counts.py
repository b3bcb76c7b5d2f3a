"""Totals over counted trigrams ``(w1, w2, w3, n)``.

Everything below trigram level derives from one small table, the pair totals split by place in the trigram, so the
trigram table is aggregated once and words are counted from pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigram.sources.text import counted_grams


def trigram_totals(rows: DataFrame, count: str = "match_count") -> DataFrame:
    """Sum per-year counts into one row per trigram; trigrams without weight are dropped."""
    return rows.groupBy("w1", "w2", "w3").agg(F.sum(count).alias("n")).where(F.col("n") > 0)


def parsed_trigram_totals(rows: DataFrame, count: str = "match_count") -> DataFrame:
    """``trigram_totals`` of parsed lines, whose words hold no spaces: counted as one string, with smaller rows."""
    return counted_grams(rows, F.sum(count)).where(F.col("n") > 0)


def drop_stopwords(trigrams: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Keep trigrams none of whose words is in the list (column ``word``).

    A list hinted for broadcast filters in place; any other list is joined by shuffle, where hot words are split. An outer
    join with a mark, unlike an anti join, stays above the aggregation of the trigrams, so that their count is shared.
    """
    kept = trigrams
    for place in ("w1", "w2", "w3"):
        listed = stopwords.select(join_key("word", place), F.lit(True).alias("listed"))
        kept = kept.join(listed, place, "left").where(F.col("listed").isNull()).drop("listed")
    return kept.select(*trigrams.columns)


def most_frequent_words(words: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent words (ties by word) as a word list."""
    return words.orderBy(F.col("n").desc(), "word").limit(k).select("word")


def pair_roles(trigrams: DataFrame) -> DataFrame:
    """``(a, b, as_first, as_second)``: the weight of a pair as (w1, w2) and as (w2, w3)."""
    none = F.lit(0).cast("bigint")
    first = F.struct(F.col("w1").alias("a"), F.col("w2").alias("b"), F.col("n").alias("f"), none.alias("s"))
    second = F.struct(F.col("w2").alias("a"), F.col("w3").alias("b"), none.alias("f"), F.col("n").alias("s"))
    return (
        trigrams.select(F.inline(F.array(first, second)))
        .groupBy("a", "b")
        .agg(F.sum("f").alias("as_first"), F.sum("s").alias("as_second"))
    )


def bigram_totals(roles: DataFrame) -> DataFrame:
    return roles.select(
        F.col("a").alias("w1"), F.col("b").alias("w2"), (F.col("as_first") + F.col("as_second")).alias("n")
    )


def unigram_totals(roles: DataFrame) -> DataFrame:
    """Each trigram counts once for each of its words: w1 and w2 from its first pair, w3 from its second."""
    left = F.struct(F.col("a").alias("word"), F.col("as_first").alias("n"))
    right = F.struct(F.col("b").alias("word"), (F.col("as_first") + F.col("as_second")).alias("n"))
    return roles.select(F.inline(F.array(left, right))).groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def join_key(name: str, alias: str | None = None) -> Column:
    """A word column of a totals table as the key of a join whose other side may be skewed.

    Adaptive execution splits a hot partition only where both inputs of the join are shuffles. Totals are already
    partitioned by their key and would enter the join without one; a key that is an expression gives them their own.
    """
    return F.concat(F.col(name), F.lit("")).alias(alias or name)


def corpus_size(unigrams: DataFrame) -> DataFrame:
    """One row: the sum of all word totals."""
    return unigrams.agg(F.sum("n").alias("c0"))


def corpus_size_direct(trigrams: DataFrame) -> DataFrame:
    """One row, straight from the trigrams: three words each."""
    return trigrams.agg(F.sum(3 * F.col("n")).alias("c0"))
