"""Association measures of a lexeme and a feature."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def association_columns(lf: Column, l: Column, f: Column, corpus_l: Column, corpus_f: Column) -> dict[str, Column]:
    """a1 count, a2 relative frequency, a3 pointwise mutual information, a4 t-test; all in double arithmetic."""
    n_lf, n_l, n_f, big_l, big_f = (c.cast("double") for c in (lf, l, f, corpus_l, corpus_f))
    return {
        "a1": n_lf,
        "a2": n_lf / n_l,
        "a3": F.log2((n_lf * big_f) / (n_l * n_f)),
        "a4": (n_lf * big_f - n_l * n_f) / (F.sqrt(big_l) * F.sqrt(n_l) * F.sqrt(n_f) * F.sqrt(big_f)),
    }
