"""Word lists, gold pairs, corpus shards, task manifests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigram.functions.stem import stem_columns


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def rejected_gold_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """``(line, reason)`` of the lines that name no pair."""
    fields = lines.select(F.col(line).alias("line"), F.size(F.split(line, "\t")).alias("n"))
    return fields.where(F.col("line").isNull() | (F.col("n") < 2)).select("line", F.lit("fewer than 2 fields").alias("reason"))


def gold_pairs(lines: DataFrame, stem: bool = True, line: str = "value") -> DataFrame:
    """``w1 TAB w2 TAB label`` to distinct ``(w1, w2, label)``; pairs that fall together keep the largest label."""
    parts = lines.select(F.split(line, "\t").alias("p")).select(
        F.get("p", F.lit(0)).alias("w1"), F.get("p", F.lit(1)).alias("w2"), F.get("p", F.lit(2)).alias("label")
    )
    if stem:
        parts = stem_columns(parts, "w1", "w2")
    return parts.where(F.col("w2").isNotNull()).groupBy("w1", "w2").agg(F.max("label").alias("label"))


def gold_vocabulary(pairs: DataFrame) -> DataFrame:
    """Every word that occurs in a pair, in either place."""
    return pairs.select(F.explode(F.array("w1", "w2")).alias("lexeme")).distinct()


def corpus_shards(files: list[str], percent: int) -> list[str]:
    """The first ``percent`` percent of the sorted shard files, rounded up; only those are then read."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    return sorted(files)[: math.ceil(len(files) * percent / 100)]


def corpus_tiers(key: Column, percents: tuple[int, ...] = (1, 10, 100)) -> Column:
    """The subset sizes a row belongs to, by its key modulo 100: nested, so 1 % is inside 10 %."""
    slot = F.pmod(key, F.lit(100))
    return F.array_compact(F.array(*[F.when(slot < p, F.lit(p)) for p in percents]))


def read_manifests(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Manifest files as ``(client, line)``; the file name stands for the client."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.[^./]*)?$", 1)
    return spark.read.text(path).select(name.alias("client"), F.col("value").alias("line"))


def rejected_manifest_lines(lines: DataFrame) -> DataFrame:
    """``(client, line, reason)`` of manifest lines ``(client, line)`` that name no task."""
    fields = lines.select("client", "line", F.split("line", "\t").alias("p"))
    reason = F.when(F.col("p").isNull() | (F.size("p") < 2), "fewer than 2 fields").when(F.get("p", F.lit(1)) == "", "no address")
    return fields.select("client", "line", reason.alias("reason")).where(F.col("reason").isNotNull())


def shard_files(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a corpus folder, in order: its shards. Hidden files and markers are none."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = [s.getPath() for s in top.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(top)]
    return sorted(str(p.toString()) for p in found if p.getName()[0] not in "._")


def parse_manifest(lines: DataFrame) -> DataFrame:
    """``(client, line)`` with ``op TAB url`` lines to ``(client, op, url)``."""
    parts = lines.select("client", F.split("line", "\t").alias("p"))
    return parts.select("client", F.get("p", F.lit(0)).alias("op"), F.get("p", F.lit(1)).alias("url"))
