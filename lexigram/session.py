"""Session settings, shared scratch folder and input spreading."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Runtime SQL settings the plans are written for. Plan-time size estimates are far too low for exploded text, so
#: they never choose a broadcast; adaptive execution picks broadcast, shuffled-hash or sort-merge join from the
#: measured size of a shuffle, and splits skewed partitions.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


#: Shuffle files go when the query that wrote them has ended; otherwise they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = 8, memory: str = "16g", shuffle_partitions: int | None = None, shared: str | None = None
) -> SparkSession:
    """Session for tests and the benchmark: one shuffle partition per core; ``shared`` becomes spark.checkpoint.dir."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    builder = SparkSession.builder.config("spark.checkpoint.dir", shared) if shared else SparkSession.builder
    spark = (
        builder.master(f"local[{cores}]")
        .appName("lexigram")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach: below ``spark.checkpoint.dir``; if that is unset, below the warehouse.

    A warehouse on the machine's own disk serves only a local master: on a cluster each executor would write to its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if warehouse.startswith("file:") and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{warehouse}/scratch"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result that several later steps read to the shared folder, and continue from the written table.

    The steps then share one computation, their plans stay small, and a lost executor costs no recomputation of it. The
    shuffles behind the table are deleted once it is written, so a plan in steps needs the disk of its largest step only.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_bytes: int = 16 * 2**20) -> DataFrame:
    """Hint a broadcast after measuring the frame; a larger one is returned as it is and joins by shuffle.

    Measuring runs the frame, so give it a stored or a source table. Meant for lists that filter a far larger table:
    without the hint that table would be shuffled before its partner's size is known.
    """
    width = sum(
        (F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType == StringType() else F.lit(0)) + 16
        for f in df.schema.fields
    )
    size = df.agg(F.sum(width).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if size <= max_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """Rebalance an input that has fewer splits than there are cores; larger inputs pass through unshuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores)
