"""Word similarity end to end: dependency lines and gold pairs in, 24-column matrix out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lexigram.operators.cooccurrence import associations, cooccurrence
from lexigram.operators.similarity import distances, labelled, pair_sums
from lexigram.session import broadcast_if_small, stored
from lexigram.sources.dependency import parse_dependency_lines
from lexigram.sources.lists import gold_pairs, gold_vocabulary


def counts(lines: DataFrame, stem: bool = True, vocabulary: DataFrame | None = None) -> DataFrame:
    rows = cooccurrence(parse_dependency_lines(lines), stem, vocabulary)
    return stored(rows, "cooccurrence") if stem else rows  # the shuffles of stemming go before the next ones come


def gold(lines: DataFrame, stem: bool = True) -> DataFrame:
    """Gold pairs ``(w1, w2, label)``, parsed and written once."""
    return stored(gold_pairs(lines, stem), "gold")


def gold_vectors(lines: DataFrame, pairs: DataFrame, stem: bool = True) -> DataFrame:
    """Association vectors of the words in ``pairs``, written once.

    The counts are written before: a filter on lexemes would sink below the counting of one of their uses, and lines would be parsed twice.
    """
    vocabulary = gold_vocabulary(pairs)
    small = broadcast_if_small(vocabulary)
    counted = counts(lines, stem, vocabulary if small is not vocabulary else None)
    return stored(associations(counted if stem else stored(counted, "cooccurrence"), small), "vectors")


def sums(lines: DataFrame, pairs: DataFrame, stem: bool = True) -> DataFrame:
    return pair_sums(gold_vectors(lines, pairs, stem), pairs)


def matrix(lines: DataFrame, pairs: DataFrame, stem: bool = True) -> DataFrame:
    """``(w1, w2, c1 .. c24)``."""
    return distances(sums(lines, pairs, stem))


def labelled_matrix(lines: DataFrame, gold_lines: DataFrame, stem: bool = True) -> DataFrame:
    """The matrix with the gold label as ``result``."""
    pairs = gold(gold_lines, stem)
    return labelled(matrix(lines, pairs, stem), pairs)
