"""Porter stemming as column expressions.

A word is first rewritten so that every ``y`` acting as a consonant becomes a mark. Vowels are then exactly the letters
``aeiouy``, and the measure of a stem (its number of vowel-consonant groups) is a plain regular expression. Each step
is its own projection, so Catalyst never inlines one step into the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "\u0001"

# Fixed values of the Porter algorithm: suffix -> replacement when the measure of the rest is above 0.
DOUBLE_SUFFIXES = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
SINGLE_SUFFIXES = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
# Suffixes dropped when the measure of the rest is above 1; ``ion`` only after s or t.
DROPPED_SUFFIXES = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "(?<=[st])ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
)

V, C = "[aeiouy]", "[^aeiouy]"
MEASURE_OVER_0 = f"^{C}*{V}+{C}"
MEASURE_OVER_1 = f"^{C}*{V}+{C}+{V}+{C}"
MEASURE_IS_1 = f"^{C}*{V}+{C}+{V}*$"
SHORT_END = f"{C}{V}[^aeiouywx{MARK}]$"


def _mark(w: Column) -> Column:
    after_vowel = F.regexp_replace(w, "(^|[aeiou])y", f"$1{MARK}")
    return F.regexp_replace(after_vowel, "yy", f"y{MARK}")


def _plural(w: Column) -> Column:
    return F.regexp_replace(w, "(?:(ss|i)es|([^s])s)$", "$1$2")


def _past_stem(w: Column) -> Column:
    """The rest before -ed or -ing when it holds a vowel, else the empty string."""
    return F.when(w.endswith("eed"), F.lit("")).otherwise(F.regexp_extract(w, f"^(.*{V}.*)(?:ed|ing)$", 1))


def _past(w: Column, rest: Column) -> Column:
    eed = F.when(
        w.endswith("eed") & F.substring(w, F.lit(1), F.length(w) - 3).rlike(MEASURE_OVER_0), F.rtrim(w, F.lit("d"))
    ).otherwise(w)
    restored = (
        F.when(rest.rlike("(?:at|bl|iz)$"), F.concat(rest, F.lit("e")))
        .when(rest.rlike(f"([^aeiouylsz])\\1$|y{MARK}$"), F.substring(rest, F.lit(1), F.length(rest) - 1))
        .when(rest.rlike("(?:ll|ss|zz)$"), rest)
        .when(rest.rlike(MEASURE_IS_1) & rest.rlike(SHORT_END), F.concat(rest, F.lit("e")))
        .otherwise(rest)
    )
    return F.when(rest != "", restored).otherwise(eed)


def _final_y(w: Column) -> Column:
    return F.regexp_replace(w, f"^(.*{V}.*)[y{MARK}]$", "$1i")


def _suffix(w: Column, suffixes) -> Column:
    return F.regexp_extract(w, f"({'|'.join(suffixes)})$", 1)


def _swap(w: Column, suffix: Column, measure: str, replacement: Column) -> Column:
    rest = F.substring(w, F.lit(1), F.length(w) - F.length(suffix))
    return F.when((suffix != "") & rest.rlike(measure), F.concat(rest, replacement)).otherwise(w)


def _table(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _final_e(w: Column) -> Column:
    rest = F.substring(w, F.lit(1), F.length(w) - 1)
    drop = w.endswith("e") & (w.rlike(MEASURE_OVER_1) | (w.rlike(MEASURE_IS_1) & ~rest.rlike(SHORT_END)))
    return F.when(drop, rest).otherwise(w)


def _final_l(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(MEASURE_OVER_1), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)


def stem_columns(df: DataFrame, *names: str) -> DataFrame:
    """Replace the named word columns by their stems. Words of one or two letters stay; case is left alone."""
    aside = {n: f"__aside_{n}" for n in names}

    def step(frame: DataFrame, new) -> DataFrame:
        return frame.withColumns({n: new(F.col(n), F.col(aside[n])) for n in names})

    def set_aside(frame: DataFrame, value) -> DataFrame:
        return frame.withColumns({aside[n]: value(F.col(n)) for n in names})

    out = df.withColumns(
        {f"__word_{n}": F.col(n) for n in names} | {n: _plural(_mark(F.col(n))) for n in names}
    )
    out = step(set_aside(out, _past_stem), _past)
    out = out.withColumns({n: _final_y(F.col(n)) for n in names})
    for table in (DOUBLE_SUFFIXES, SINGLE_SUFFIXES):
        out = set_aside(out, lambda w, t=table: _suffix(w, t))
        out = step(out, lambda w, suffix, t=table: _swap(w, suffix, MEASURE_OVER_0, _table(t)[suffix]))
    out = set_aside(out, lambda w: _suffix(w, DROPPED_SUFFIXES))
    out = step(out, lambda w, suffix: _swap(w, suffix, MEASURE_OVER_1, F.lit("")))
    out = out.withColumns({n: _final_e(F.col(n)) for n in names})
    out = out.withColumns({n: _final_l(F.col(n)) for n in names})
    stemmed = {
        n: F.when(F.length(f"__word_{n}") < 3, F.col(f"__word_{n}")).otherwise(F.replace(n, F.lit(MARK), F.lit("y")))
        for n in names
    }
    # A generator ends the lineage of the columns: when a stem becomes a join key, optimizer rules that trace keys to
    # their source would otherwise expand all the steps into one expression, whose size is exponential in their number.
    row = F.struct(*[F.col(c) for c in df.columns])
    return out.withColumns(stemmed).select(F.inline(F.array(row)))
