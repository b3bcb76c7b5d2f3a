"""Distances and similarities of two sparse vectors from nine running sums per measure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEASURES = (1, 2, 3, 4)
SUMS = ("abs", "sq", "dot", "sq1", "sq2", "min", "max", "add", "js")


def js_term(a: Column, b: Column) -> Column:
    """One feature's share of the Jensen-Shannon sum; a side whose ratio to the mean is not positive adds 0."""
    both = a + b

    def side(x: Column) -> Column:
        ratio = 2.0 * x / both
        return F.when(ratio > 0, x * F.log2(ratio)).otherwise(0.0)

    return F.when(both != 0, side(a) + side(b)).otherwise(0.0)


def manhattan(s: dict[str, Column]) -> Column:
    return s["abs"]


def euclid(s: dict[str, Column]) -> Column:
    return F.sqrt(s["sq"])


def cosine(s: dict[str, Column]) -> Column:
    norm = F.sqrt(s["sq1"]) * F.sqrt(s["sq2"])
    return F.when(norm > 0, s["dot"] / norm).otherwise(-1.0)


def jaccard(s: dict[str, Column]) -> Column:
    return F.when(s["max"] > 0, s["min"] / s["max"]).otherwise(-1.0)


def dice(s: dict[str, Column]) -> Column:
    return F.when(s["add"] > 0, 2.0 * s["min"] / s["add"]).otherwise(-1.0)


def jensen_shannon(s: dict[str, Column]) -> Column:
    return s["js"]


#: In column order: c1-c4 Manhattan, c5-c8 Euclid, c9-c12 cosine, c13-c16 Jaccard, c17-c20 Dice, c21-c24 JS.
DISTANCES = (manhattan, euclid, cosine, jaccard, dice, jensen_shannon)


def distance_columns(functions=DISTANCES) -> dict[str, Column]:
    """``c<i>`` for the given functions over columns named ``<sum>_<measure>``."""
    out = {}
    for fn in functions:
        first = 4 * DISTANCES.index(fn)
        for m in MEASURES:
            out[f"c{first + m}"] = fn({s: F.col(f"{s}_{m}") for s in SUMS})
    return out
