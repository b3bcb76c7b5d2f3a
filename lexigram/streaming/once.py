"""Each key of a stream once, with a state that doesn't grow: the written results are the memory.

Results lie in one folder per batch, dealt by hash into buckets. A Bloom filter per bucket says which rows of a new batch may
have been there before; only the buckets of those rows are read, and only those rows are joined with them. A new row
costs no reading of old results, and the answer stays exact however long ago a key came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lexigram.streaming.tasks import _folders

BUCKETS = 64
#: 64-bit words of a bucket's filter; a key sets two bits.
WORDS = 65_536
#: Batches between two sums of the filters.
SUM_EVERY = 50


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _bits(keys: list[str]) -> Column:
    """The two bits of a key, as an array of (word, mask)."""
    pairs = []
    for seed in (1, 2):
        place = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(64 * WORDS))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))
        pairs.append(F.struct(F.floor(place / 64).cast("int").alias("word"), mask.alias("mask")))
    return F.array(*pairs)


def _filter_of(rows: DataFrame) -> DataFrame:
    """``(bucket, word, bits)`` from rows (bucket, word, mask)."""
    return rows.groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))


def _union(spark: SparkSession, paths: list[str], schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _filters(spark: SparkSession, out: str, before: int) -> DataFrame:
    """The filter of all batches before this one: the latest sum and the batches since."""
    found = _folders(spark, f"{out}/filters")
    base = max((n for n in found["snapshot"] if n < before), default=-1)
    paths = [found["snapshot"][base]] if base >= 0 else []
    paths += [p for n, p in found["batch"].items() if base < n < before]
    return _filter_of(_union(spark, paths, "bucket int, word int, bits bigint").withColumnRenamed("bits", "mask"))


def _written(spark: SparkSession, out: str, fields: list[StructField]) -> DataFrame:
    """All results with their ``batch`` and ``bucket``, by which reading is pruned."""
    schema = StructType([StructField(f.name, f.dataType) for f in fields]).add("batch", "integer").add("bucket", "integer")
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/rows")
    there = top.getFileSystem(spark._jsc.hadoopConfiguration()).exists(top)
    return spark.read.schema(schema).parquet(f"{out}/rows") if there else spark.createDataFrame([], schema)


def unseen(batch: DataFrame, keys: list[str], out: str, before: int) -> DataFrame:
    """Rows of ``batch`` (keys distinct) that no batch before this one has written to ``out``."""
    spark = batch.sparkSession
    bits = batch.select(*keys, _bucket(keys).alias("bucket"), F.inline(_bits(keys)))
    met = bits.join(_filters(spark, out, before), ["bucket", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    perhaps = met.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select(*keys, "bucket").persist()
    try:
        buckets = [r["bucket"] for r in perhaps.select("bucket").distinct().collect()]  # BUCKETS at most
        if not buckets or not before:
            return batch
        fields = [f for f in batch.schema.fields if f.name in keys]
        old = _written(spark, out, fields).where((F.col("batch") < before) & F.col("bucket").isin(buckets))
        seen = old.join(perhaps.drop("bucket"), keys, "left_semi").select(*keys).distinct()
        return batch.join(seen, keys, "left_anti")
    finally:
        perhaps.unpersist()


def run_once(stream: DataFrame, keys: list[str], out: str, state: str, sum_every: int = SUM_EVERY) -> DataFrame:
    """Run a stream over all waiting input and return every row of ``out``: the first one of each key (not null).

    A batch overwrites its own folders and looks at earlier ones only, so one that is repeated after a failure comes out the same.
    """
    fields = stream.schema.fields

    def write(batch: DataFrame, n: int) -> None:
        new = unseen(batch.dropDuplicates(keys), keys, out, n).withColumn("bucket", _bucket(keys))
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/rows/batch={n}")
        rows = _written(batch.sparkSession, out, fields).where(F.col("batch") == n).select("bucket", F.inline(_bits(keys)))
        _filter_of(rows).write.mode("overwrite").parquet(f"{out}/filters/batch-{n}")
        if (n + 1) % sum_every == 0:
            _filters(batch.sparkSession, out, n + 1).write.mode("overwrite").parquet(f"{out}/filters/snapshot-{n}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return _written(stream.sparkSession, out, fields).select(*stream.columns)
