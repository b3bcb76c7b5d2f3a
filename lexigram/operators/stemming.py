"""Stems of a vocabulary, and counts rolled up onto stems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigram.functions.stem import stem_columns
from lexigram.operators.counts import join_key
from lexigram.session import broadcast_if_small, stored


def stem_vocabulary(words: DataFrame) -> DataFrame:
    """``(word, stem)``, each distinct word stemmed once."""
    return stem_columns(words.select("word").distinct().withColumn("stem", F.col("word")), "stem")


def with_stems(rows: DataFrame, *names: str) -> DataFrame:
    """``rows`` with the named word columns replaced by their stems.

    Each distinct word is stemmed once, and those that differ from their stem are written. A list of these that was measured to be small
    is then broadcast, so that all columns are replaced in one pass; a larger one is joined by shuffles of its own, in which hot words are
    split. Rows with a null word are dropped.
    ``rows`` is read once for the words and once more: give it a written table.
    """
    words = rows.select(F.explode(F.array_distinct(F.array(*names))).alias("word"))
    stems = stored(stem_vocabulary(words).where("word != stem"), "stems")
    small = broadcast_if_small(stems)
    for name in names:
        stem = small.select(F.col("word").alias(name) if small is not stems else join_key("word", name), F.col("stem").alias(f"__stem_{name}"))
        rows = rows.where(F.col(name).isNotNull()).join(stem, name, "left")
        rows = rows.withColumn(name, F.coalesce(f"__stem_{name}", name)).drop(f"__stem_{name}")
    return rows


def stemmed_counts(words: DataFrame) -> DataFrame:
    """``(stem, n)`` from counted words ``(word, n)``: stemming runs on the counted vocabulary, not on the text."""
    return (
        stem_columns(words.select(F.col("word").alias("stem"), "n"), "stem").groupBy("stem").agg(F.sum("n").alias("n"))
    )
