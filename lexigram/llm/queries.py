"""The queries of this folder: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexigram.llm import (
    decontaminate, licences, merkle, minhash, neighbours, packing, pages, quality, repeats, secrets, token_counts, token_files,
    whitening,
)
from lexigram.llm.common import table
from lexigram.llm.oracle import LLM_ORACLE

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op1_neighbours(spark, sf_dir):
    return neighbours.report(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op2_quality(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_decontamination(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query
def op4_secrets(spark, sf_dir):
    return secrets.report(table(spark, sf_dir, "documents"))


@query
def op5_near_duplicates(spark, sf_dir):
    return minhash.report(table(spark, sf_dir, "documents"))


@query
def op6_html(spark, sf_dir):
    return pages.report(table(spark, sf_dir, "pages"))


@query
def op7_packing(spark, sf_dir):
    return packing.report(table(spark, sf_dir, "documents"))


@query
def op8_token_counts(spark, sf_dir):
    return token_counts.report(table(spark, sf_dir, "documents"))


@query
def op9_token_files(spark, sf_dir):
    return token_files.report(table(spark, sf_dir, "documents"))


@query
def op10_licences(spark, sf_dir):
    return licences.report(table(spark, sf_dir, "documents"))


@query
def op11_whitening(spark, sf_dir):
    return whitening.report(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op12_merkle(spark, sf_dir):
    return merkle.report(table(spark, sf_dir, "documents"))


@query
def op13_repeats(spark, sf_dir):
    return repeats.report(table(spark, sf_dir, "documents"))
