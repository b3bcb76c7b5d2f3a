"""Dependency-arc lines: ``head TAB word/POS/dep/head_index .. TAB total TAB ..``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STARTS_WITH_LETTER = r"^\p{L}"
#: What a cast takes for a whole number, except for its size: white space and control characters around it don't count.
WHOLE_NUMBER = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*\z"


#: Stands for the head index of a word arc that has none.
NO_INDEX = -(2**40)


def _starts_with_letter(text: Column) -> Column:
    """Most texts begin with a letter from a to z, which a comparison tells; the others take the pattern."""
    plain = ((text >= "a") & (text < "{")) | ((text >= "A") & (text < "["))
    return plain | text.rlike(STARTS_WITH_LETTER)


def _index(text: Column) -> Column:
    """``text`` as an int, null if it is none.

    A cast that fails throws and catches an exception, which takes as long as parsing the rest of the line; so only what looks like a
    number is cast. A single digit, the usual case, needs no pattern for that.
    """
    digit = (F.length(text) == 1) & text.between("0", "9")
    return F.when(digit | text.rlike(WHOLE_NUMBER), text.try_cast("int"))


def _arc(parts: Column) -> Column:
    word = F.get(parts, F.lit(0))
    return F.struct(
        word.alias("word"),
        F.get(parts, F.lit(1)).alias("pos"),
        F.get(parts, F.lit(2)).alias("dep"),
        _index(F.get(parts, F.lit(3))).alias("head_idx"),
        _starts_with_letter(word).alias("is_word"),
    )


def _hangs_at(arc: Column) -> Column:
    """The head index of a word arc, ``NO_INDEX`` where it has none; null for other arcs."""
    return F.when(arc["is_word"], F.coalesce(arc["head_idx"].cast("bigint"), F.lit(NO_INDEX)))


def parse_dependency_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """``(line, head, arcs, total, root, reason)``, one row per line.

    ``root`` is the 1-based position of the first word arc whose head is 0 (0 when there is none). ``reason`` is
    null for usable lines; a word arc with fewer than four parts or without a numeric head spoils the whole line.
    """
    fields = lines.select(F.col(line).alias("line"), F.split(line, "\t").alias("parts"))
    arcs = fields.select(
        "line",
        F.get("parts", F.lit(0)).alias("head"),
        F.transform(
            F.transform(F.split(F.get("parts", F.lit(1)), " "), lambda arc: F.split(arc, "/")), _arc
        ).alias("arcs"),
        F.get("parts", F.lit(2)).try_cast("bigint").alias("total"),
    )
    placed = arcs.select("*", F.transform("arcs", _hangs_at).alias("at"))
    reason = (
        F.when(~_starts_with_letter(F.col("line")), "head does not start with a letter")
        .when(F.col("arcs").isNull() | F.col("total").isNull(), "fewer than 3 fields or no count")
        .when(F.array_contains("at", F.lit(NO_INDEX)), "bad head index")
    )
    root = F.array_position("at", F.lit(0).cast("bigint")).cast("int")
    return placed.select("line", "head", "arcs", "total", root.alias("root"), reason.alias("reason"))


def dependency_rows(parsed: DataFrame) -> DataFrame:
    """Usable lines as ``(head, arcs, total, root)``, arcs without the helper flag."""
    plain = F.transform(
        "arcs",
        lambda a: F.struct(
            a["word"].alias("word"), a["pos"].alias("pos"), a["dep"].alias("dep"), a["head_idx"].alias("head_idx")
        ),
    )
    row = F.struct("head", plain.alias("arcs"), "total", "root")
    return parsed.select(F.inline(F.when(F.col("reason").isNull(), F.array(row))))


def rejected_dependency_lines(parsed: DataFrame) -> DataFrame:
    row = F.struct("line", "reason")
    return parsed.select(F.inline(F.when(F.col("reason").isNotNull(), F.array(row))))


def feature_arcs() -> Column:
    """The word arcs that hang on the root."""
    return F.filter("arcs", lambda a: a["is_word"] & (a["head_idx"] == F.col("root")) & (F.col("root") > 0))
