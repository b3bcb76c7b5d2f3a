"""Vector distances of word pairs.

A pair's nine sums per measure split into per-word sums over the whole vector and corrections over shared features
only. Only the shorter vector of a pair is expanded, and it is looked up in the longer one; the words of a gold list
with very long vectors are thus never expanded once per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigram.functions.distance import DISTANCES, MEASURES, SUMS, distance_columns, js_term
from lexigram.operators.counts import join_key

VALUES = tuple(f"a{m}" for m in MEASURES)
#: Cells of pairs per task: what a task groups stays in memory.
CELLS = 2**19


def dealt_by_feature(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """``vectors`` (from a written table), shuffled so that no task makes many more than ``CELLS`` rows of ``pair_features``.

    The size of the vectors says little about that: a row is copied to every pair of its word. A feature has one row per word at most.
    """
    held = pairs.select(F.explode(F.array("w1", "w2")).alias("lexeme")).groupBy("lexeme").agg(F.count(F.lit(1)).alias("pairs"))
    cells = vectors.groupBy("lexeme").agg(F.count(F.lit(1)).alias("n")).join(held, "lexeme").agg(F.sum(F.col("n") * F.col("pairs"))).first()[0]
    return vectors.repartition(max((cells or 0) // CELLS + 1, vectors.sparkSession.sparkContext.defaultParallelism), "feature")


def pair_features(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(w1, w2, feature, side, a1 .. a4)``: each vector in both of its roles.

    One join on the word: where the pairs are broadcast, the rows stay where their vectors' rows are.
    """
    role = lambda side, word: F.struct(F.col(word).alias("lexeme"), "w1", "w2", F.lit(side).alias("side"))
    roles = pairs.select(F.inline(F.array(role(1, "w1"), role(2, "w2"))))
    return vectors.join(roles, "lexeme").select("w1", "w2", "feature", "side", *VALUES)


def pair_vectors(features: DataFrame) -> DataFrame:
    """``(w1, w2, feature, x1 .. x4, y1 .. y4)``: both sides in one row, an absent side 0."""
    cells = [
        F.coalesce(F.max(F.when(F.col("side") == side, F.col(f"a{m}"))), F.lit(0.0)).alias(f"{name}{m}")
        for side, name in ((1, "x"), (2, "y"))
        for m in MEASURES
    ]
    return features.groupBy("w1", "w2", "feature").agg(*cells)


def vector_norms(vectors: DataFrame) -> DataFrame:
    """Per lexeme: size, and per measure the sum, the squared sum and the sums of positive and negative values."""
    zero = F.lit(0.0)
    sums = [F.count("feature").alias("size")]
    for m in MEASURES:
        a = F.col(f"a{m}")
        sums += [
            F.sum(a).alias(f"sum_{m}"),
            F.sum(a * a).alias(f"sq_{m}"),
            F.sum(F.greatest(a, zero)).alias(f"pos_{m}"),
            F.sum(F.least(a, zero)).alias(f"neg_{m}"),
        ]
    return vectors.groupBy("lexeme").agg(*sums)


def _with_norms(pairs: DataFrame, norms: DataFrame) -> DataFrame:
    """Pairs of which at least one word has a vector, with both words' norms (0 for a missing vector)."""
    out = pairs.select("w1", "w2")
    names = [c for c in norms.columns if c != "lexeme"]
    for word, side in (("w1", "x"), ("w2", "y")):
        renamed = norms.select(join_key("lexeme", word), *[F.col(c).alias(f"{side}_{c}") for c in names])
        out = out.join(renamed, word, "left")
    filled = out.fillna(0, [f"{side}_{c}" for side in "xy" for c in names])
    return filled.where((F.col("x_size") > 0) | (F.col("y_size") > 0))


def _shared_sums() -> list[Column]:
    """Per measure, over the features both words have: what to add to the sums over the single vectors."""
    zero = F.lit(0.0)
    sums = [F.count(F.lit(1)).alias("shared")]
    for m in MEASURES:
        x, y = F.col(f"x{m}"), F.col(f"y{m}")
        least = F.least(x, y) - F.least(x, zero) - F.least(y, zero)
        greatest = F.greatest(x, y) - F.greatest(x, zero) - F.greatest(y, zero)
        sums += [
            F.sum((x - y) * (x - y)).alias(f"diff_{m}"),
            F.sum(x * y).alias(f"dot_{m}"),
            F.sum(x * x).alias(f"xx_{m}"),
            F.sum(y * y).alias(f"yy_{m}"),
            F.sum(least).alias(f"least_{m}"),
            F.sum(greatest).alias(f"greatest_{m}"),
            F.sum(js_term(x, y) - x - y).alias(f"jsd_{m}"),
        ]
    return sums


def _shared(sized: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(w1, w2, shared, ..)`` for the pairs whose vectors meet."""
    first_is_short = F.col("x_size") <= F.col("y_size")
    ends = sized.where((F.col("x_size") > 0) & (F.col("y_size") > 0)).select(
        "w1",
        "w2",
        first_is_short.alias("forward"),
        F.when(first_is_short, F.col("w1")).otherwise(F.col("w2")).alias("short"),
        F.when(first_is_short, F.col("w2")).otherwise(F.col("w1")).alias("long"),
    )
    short = vectors.select(F.col("lexeme").alias("short"), "feature", *[F.col(a).alias(f"s_{a}") for a in VALUES])
    long = vectors.select(F.col("lexeme").alias("long"), "feature", *[F.col(a).alias(f"l_{a}") for a in VALUES])
    met = ends.join(short, "short").join(long, ["long", "feature"])
    sides = []
    for a in VALUES:
        s, l = F.col(f"s_{a}"), F.col(f"l_{a}")
        sides.append(F.when(F.col("forward"), s).otherwise(l).alias(a.replace("a", "x")))
        sides.append(F.when(F.col("forward"), l).otherwise(s).alias(a.replace("a", "y")))
    return met.select("w1", "w2", *sides).groupBy("w1", "w2").agg(*_shared_sums())


def pair_sums(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(w1, w2, abs_1 .. js_4)``: the nine sums for each measure and pair; no row where neither word has a vector.

    The vectors are read several times, so they should come from a written table.
    """
    sized = _with_norms(pairs, vector_norms(vectors))
    shared = _shared(sized, vectors)
    extra = [c for c in shared.columns if c not in ("w1", "w2")]
    rows = sized.join(shared, ["w1", "w2"], "left").fillna(0, extra)
    out = []
    for m in MEASURES:
        total = {c: F.col(f"x_{c}_{m}") + F.col(f"y_{c}_{m}") for c in ("sum", "pos", "neg")}
        sq1, sq2 = F.col(f"x_sq_{m}"), F.col(f"y_sq_{m}")
        # What lies outside the shared features is exactly nothing when all of them are shared.
        rest1 = F.when(F.col("x_size") > F.col("shared"), sq1 - F.col(f"xx_{m}")).otherwise(0.0)
        rest2 = F.when(F.col("y_size") > F.col("shared"), sq2 - F.col(f"yy_{m}")).otherwise(0.0)
        least = total["neg"] + F.col(f"least_{m}")
        greatest = total["pos"] + F.col(f"greatest_{m}")
        sums = {
            "abs": greatest - least,
            "sq": F.col(f"diff_{m}") + rest1 + rest2,
            "dot": F.col(f"dot_{m}"),
            "sq1": sq1,
            "sq2": sq2,
            "min": least,
            "max": greatest,
            "add": total["sum"],
            "js": total["sum"] + F.col(f"jsd_{m}"),
        }
        out += [sums[s].alias(f"{s}_{m}") for s in SUMS]
    return rows.select("w1", "w2", *out)


def distances(sums: DataFrame, functions=DISTANCES) -> DataFrame:
    """``(w1, w2, c..)`` for the given distance functions; all six give c1 .. c24."""
    return sums.select("w1", "w2", *[c.alias(name) for name, c in distance_columns(functions).items()])


def labelled(matrix: DataFrame, gold: DataFrame) -> DataFrame:
    """The matrix with a ``result`` label; null where the list has none."""
    return matrix.join(gold.select("w1", "w2", F.col("label").alias("result")), ["w1", "w2"], "left")
