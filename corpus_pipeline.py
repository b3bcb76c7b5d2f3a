"""A training corpus from ``documents``: rejects, near duplicates and leaked benchmark texts go, secrets are masked, and what is
left is packed into token sequences. Every stage is written and reread before the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigram.llm import decontaminate, minhash, packing, quality, secrets
from lexigram.llm.common import importable, table
from lexigram.session import stored


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, doesn't reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return minhash.one_per_class(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret is replaced by its kind in brackets."""
    return secrets.masked(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", accept),
    ("near duplicates", one_of_each),
    ("benchmark decontamination", clean),
    ("secret scans", mask),
    ("packing", pack),
]

#: No SQL: the first stage fits a model and the last runs a tokenizer library; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(importable(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if k == len(STAGES) - 1 else stored(docs, "stage")
    return docs
