"""Raw text to words, n-gram occurrences and n-gram counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(name: str) -> Column:
    """A word column known to hold no nulls.

    Joins then add no null filters. Such filters sink to the source of one use of a count table but not of another,
    and the two uses could no longer share one shuffle.
    """
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def words(text: Column) -> Column:
    """Lower-cased maximal runs of letters, in order."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def ngram_occurrences(docs: DataFrame, size: int, text: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row per run of ``size`` consecutive words: ``keep`` columns, then ``w1 .. w<size>``.

    Shifted slices are zipped and inlined, so short texts give an empty array and need no filter
    (a filter would be pushed below the tokenizer and run it a second time).
    """
    tokens = docs.select(*keep, words(F.col(text)).alias("ws"))
    runs = F.greatest(F.size("ws") - (size - 1), F.lit(0))
    shifted = [F.slice("ws", i + 1, runs) for i in range(size)]
    names = [f"w{i + 1}" for i in range(size)]
    kept = [c for c in tokens.columns if c != "ws"]
    runs_of_words = tokens.select(*kept, F.inline(F.arrays_zip(*shifted)).alias(*names))
    return runs_of_words.select(*kept, *[not_null(n) for n in names])


def trigrams_from_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counted word trigrams ``(w1, w2, w3, n)``; counts are summed map-side before the shuffle."""
    return ngram_occurrences(docs, 3, text).groupBy("w1", "w2", "w3").agg(F.count(F.lit(1)).alias("n"))


def counted_grams(occurrences: DataFrame, total: Column | None = None) -> DataFrame:
    """``(w1, w2, w3, n)`` of trigram occurrences, or of rows whose counts ``total`` sums up. What is counted is one string, whose rows
    are far smaller than those of three columns; words of a text or of parsed n-gram lines hold no spaces."""
    rows = occurrences.withColumn("gram", F.concat_ws(" ", "w1", "w2", "w3")).drop("w1", "w2", "w3")
    counted = rows.groupBy("gram").agg((F.count(F.lit(1)) if total is None else total).alias("n"))
    parts = counted.select(F.split("gram", " ").alias("ws"), "n")
    return parts.select(*[F.coalesce(F.get("ws", F.lit(i)), F.lit("")).alias(f"w{i + 1}") for i in range(3)], "n")


def trigram_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)``: how many trigrams hold a word, once for each of its places, with no trigram formed.

    The word at place i of m is held by the trigrams that start at i - 2 .. i, as far as they lie within the text. One row per
    word is summed map-side, so that a shuffle holds words only.
    """
    tokens = docs.select(words(F.col(text)).alias("ws"))
    placed = tokens.select(F.size("ws").alias("m"), F.posexplode("ws").alias("i", "word"))
    held = F.least(F.col("i"), F.col("m") - 3) - F.greatest(F.col("i") - 2, F.lit(0)) + 1
    return placed.groupBy("word").agg(F.sum(F.greatest(held, F.lit(0))).alias("n")).where("n > 0")


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counted words ``(word, n)``."""
    return (
        docs.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )
