"""Lexeme-feature co-occurrence from dependency lines, and association measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigram.functions.association import association_columns
from lexigram.functions.stem import stem_columns
from lexigram.operators.counts import join_key
from lexigram.operators.stemming import with_stems
from lexigram.session import stored
from lexigram.sources.dependency import feature_arcs
from lexigram.sources.text import not_null


def roots(parsed: DataFrame) -> DataFrame:
    """``(line, root)`` of usable lines."""
    row = F.struct("line", "root")
    return parsed.select(F.inline(F.when(F.col("reason").isNull(), F.array(row))))


def features(parsed: DataFrame, stem: bool = False) -> DataFrame:
    """``(lexeme, feature, total)``, one row per arc on the root of a usable line."""
    rows = F.transform(
        feature_arcs(), lambda a: F.struct(F.col("head").alias("lexeme"), a["word"], a["dep"], F.col("total"))
    )
    flat = parsed.select(F.inline(F.when(F.col("reason").isNull(), rows)).alias("lexeme", "word", "dep", "total"))
    if stem:
        flat = stem_columns(flat, "lexeme", "word")
    return flat.select("lexeme", F.concat_ws("-", "word", "dep").alias("feature"), "total")


def contributions(parsed: DataFrame, stem: bool = False) -> DataFrame:
    """``(lexeme, feature, n, is_pair)``, uncounted: a line's total for the lexeme itself (feature empty) and for each feature on its root.

    Sums over many lexemes or features are taken from these rows; what would be counted per lexeme and feature first need not be shuffled.
    With ``stem`` words are pre-counted as written; every distinct word is then stemmed once and the stems joined back.
    """
    hung = F.when(F.col("reason").isNull(), F.concat(F.array(F.lit(None)), feature_arcs()))  # the empty place is the lexeme's own
    rows = parsed.select(F.col("head").alias("lexeme"), F.col("total").alias("n"), F.explode(hung).alias("arc"))
    word, kind = F.coalesce("arc.word", F.lit("")), F.when(F.col("arc").isNotNull(), F.col("arc.dep")).otherwise("")
    rows = rows.select("lexeme", word.alias("word"), kind.alias("dep"), "n", F.col("arc").isNotNull().alias("pair"))
    if stem:
        counted = rows.groupBy("lexeme", "word", "dep").agg(F.sum("n").alias("n"), F.max("pair").alias("pair"))
        rows = with_stems(stored(counted, "counted"), "lexeme", "word")
    feature = F.when(F.col("pair"), F.concat_ws("-", "word", "dep")).otherwise("")
    return rows.select(not_null("lexeme"), feature.alias("feature"), "n", F.col("pair").alias("is_pair"))


def cooccurrence(parsed: DataFrame, stem: bool = False, vocabulary: DataFrame | None = None) -> DataFrame:
    """``(lexeme, feature, n, is_pair)``: all counts from one pass and one shuffle.

    ``is_pair`` is an aggregate on purpose: filters on it stay above the shuffle, so every table cut from this one shares it.
    With a ``vocabulary`` (column ``lexeme``, small enough to be broadcast) all other lexemes are counted together under a null, so
    that totals of features and of the corpus stay whole, and only the vectors that are asked for are shuffled.
    """
    rows = contributions(parsed, stem)
    if vocabulary is not None:
        listed = F.broadcast(vocabulary.select("lexeme", F.lit(True).alias("listed")).distinct())
        rows = rows.join(listed, "lexeme", "left").withColumn("lexeme", F.when(F.col("listed"), F.col("lexeme")))
    return rows.groupBy("lexeme", "feature").agg(F.sum("n").alias("n"), F.max("is_pair").alias("is_pair"))


def lexeme_totals(counts: DataFrame) -> DataFrame:
    """``(lexeme, count_l)``: the totals of the lexeme's lines, features or not."""
    return counts.where(~F.col("is_pair")).select("lexeme", F.col("n").alias("count_l"))


def pair_totals(counts: DataFrame) -> DataFrame:
    """``(lexeme, feature, count_lf)``."""
    return counts.where("is_pair").select("lexeme", "feature", F.col("n").alias("count_lf"))


def pair_totals_with_lexeme(counts: DataFrame) -> DataFrame:
    """``(lexeme, feature, count_lf, count_l)``."""
    return pair_totals(counts).join(lexeme_totals(counts), "lexeme").select("lexeme", "feature", "count_lf", "count_l")


def feature_totals(counts: DataFrame) -> DataFrame:
    """``(feature, count_f)``."""
    return counts.where("is_pair").groupBy("feature").agg(F.sum("n").alias("count_f"))


def corpus_totals(counts: DataFrame) -> DataFrame:
    """One row ``(l, f)``: the line totals, and the line totals times their number of features."""
    of = lambda pair: F.coalesce(F.sum(F.when(F.col("is_pair") == pair, F.col("n"))), F.lit(0).cast("bigint"))
    return counts.agg(of(False).alias("l"), of(True).alias("f"))


def associations(counts: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """``(lexeme, feature, a1 .. a4)``, for the lexemes of ``vocabulary`` if given.

    The vocabulary cuts the pair table before the joins; totals still come from the whole corpus.
    """
    pairs = pair_totals(counts)
    if vocabulary is not None:
        pairs = pairs.join(vocabulary.select(join_key("lexeme")), "lexeme", "left_semi")
    totals_of_features = feature_totals(counts).select(join_key("feature"), "count_f")
    rows = pairs.join(lexeme_totals(counts), "lexeme").join(totals_of_features, "feature")
    totals = corpus_totals(counts)
    measures = association_columns(
        F.col("count_lf"),
        F.col("count_l"),
        F.col("count_f"),
        totals.select("l").scalar(),
        totals.select("f").scalar(),
    )
    return rows.select("lexeme", "feature", *[c.alias(name) for name, c in measures.items()])
