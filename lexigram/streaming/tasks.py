"""Task results as a stream: decode, drop repeats, progress per client, unresolved clients.

Streams read a folder of messages and write to folders that all executors share; results are read back from there,
never through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lexigram.functions.messages import decode, upload_total

#: Micro-batches between two snapshots of the latest rows.
SNAPSHOT_EVERY = 50

MESSAGE_SCHEMA = "ts timestamp, value string"


def read_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of message files ``(ts, value)`` as a stream; by default all waiting files form one batch."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def decoded(messages: DataFrame) -> DataFrame:
    """``(ts, value, client, content, total, parts, reason)``.

    ``total`` is set on control records only; ``reason`` says why a record is neither control nor data, and is null else.
    """
    rows = messages.select("ts", "value", decode(F.col("value")).alias("m")).select(
        "ts", "value", F.col("m.localID").alias("client"), F.col("m.content").alias("content")
    )
    rows = rows.withColumns({"total": upload_total(F.col("content")), "parts": F.split("content", "\t")})
    reason = F.when(F.col("client").isNull() | F.col("content").isNull(), "not a message").when(
        F.col("total").isNull() & (F.size("parts") < 3), "fewer than 3 fields"
    )
    return rows.withColumn("reason", reason)


def rejected_messages(messages: DataFrame) -> DataFrame:
    """``(ts, value, reason)`` of the records that say nothing about a task."""
    return decoded(messages).where(F.col("reason").isNotNull()).select("ts", "value", "reason")


def task_results(messages: DataFrame) -> DataFrame:
    """Data records as ``(ts, client, op, task, result, status)``; status is done, error, or open without a result."""
    rows = decoded(messages).where(F.col("reason").isNull() & F.col("total").isNull())
    result = F.get("parts", F.lit(2))
    status = F.when(result == "", "open").when(result.startswith("DoneLocalId"), "done").otherwise("error")
    return rows.select(
        "ts",
        "client",
        F.get("parts", F.lit(0)).alias("op"),
        F.get("parts", F.lit(1)).alias("task"),
        result.alias("result"),
        status.alias("status"),
    )


def without_repeats(results: DataFrame) -> DataFrame:
    """First delivery of each task, and first record of it as open, however late and in whichever micro-batch it comes.

    Exact, so the state holds one key per task of every client; keep it in the RocksDB state store.
    """
    return (
        results.withColumn("is_open", F.col("status") == "open")
        .dropDuplicates(["client", "task", "is_open"])
        .drop("is_open")
    )


def progress(messages: DataFrame) -> DataFrame:
    """``(client, done, total)`` per client: distinct finished tasks and the announced number of tasks.

    Control records have a kind of their own: no task name can be taken for one, and repeated announcements count once.
    """
    rows = decoded(messages).where(F.col("reason").isNull())
    is_control = F.col("total").isNotNull()
    finished = rows.where(is_control | (F.get("parts", F.lit(2)) != ""))
    keyed = finished.select(
        "client",
        is_control.alias("is_control"),
        F.when(is_control, F.col("content")).otherwise(F.get("parts", F.lit(1))).alias("task"),
        "total",
    )
    return (
        keyed.dropDuplicates(["client", "is_control", "task"])
        .groupBy("client")
        .agg(F.count_if(~F.col("is_control")).alias("done"), F.max("total").alias("total"))
    )


def run_append(stream: DataFrame, out: str, state: str) -> DataFrame:
    """Run an append-mode stream over all waiting input into the folder ``out`` and return what is there.

    Run again with the same ``state`` folder it takes up where it stopped and adds only what is new.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def _folders(spark: SparkSession, out: str) -> dict[str, dict[int, str]]:
    """Finished folders ``snapshot-N`` and ``batch-N`` below ``out``, by kind and number."""
    jvm, found = spark._jvm, {"snapshot": {}, "batch": {}}
    top = jvm.org.apache.hadoop.fs.Path(out)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(top) if files.exists(top) else []:
        kind, _, number = status.getPath().getName().partition("-")
        if kind in found and files.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[kind][int(number)] = status.getPath().toString()
    return found


def _latest(spark: SparkSession, schema: StructType, key: str, folders: dict[int, str]) -> DataFrame:
    """The row of the folder with the highest number for each key."""
    columns = [f.name for f in schema.fields]
    parts = [spark.read.schema(schema).parquet(p).withColumn("at", F.lit(n)) for n, p in sorted(folders.items())]
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema).withColumn("at", F.lit(0))
    values = F.struct(*[c for c in columns if c != key])
    return rows.groupBy(key).agg(F.max_by(values, "at").alias("v")).select(key, "v.*").select(*columns)


def _since_snapshot(found: dict[str, dict[int, str]], upto: int | None = None) -> dict[int, str]:
    """The newest snapshot below ``upto`` and the batches after it up to ``upto``."""
    snapshots = {n: p for n, p in found["snapshot"].items() if upto is None or n < upto}
    base = max(snapshots, default=-1)
    batches = {n: p for n, p in found["batch"].items() if n > base and (upto is None or n <= upto)}
    return batches | ({base: snapshots[base]} if snapshots else {})


def run_latest(stream: DataFrame, key: str, out: str, state: str, keep: int = SNAPSHOT_EVERY) -> DataFrame:
    """Run an update-mode stream over all waiting input into ``out`` and return the latest row per ``key``.

    Each micro-batch overwrites its own folder, so a batch repeated after a failure leaves one copy. Every ``keep`` batches
    a snapshot sums up the one before and the batches since; what the snapshot before the last stands for is deleted,
    so reading and storage stay bounded by the keys and ``2 * keep`` batches.
    """
    spark, schema = stream.sparkSession, StructType([StructField(f.name, f.dataType) for f in stream.schema.fields])

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{out}/batch-{batch_id}")
        if (batch_id + 1) % keep:
            return
        found = _folders(own, out)
        base = max((n for n in found["snapshot"] if n < batch_id), default=-1)
        latest = _latest(own, schema, key, _since_snapshot(found, batch_id))
        latest.write.mode("overwrite").parquet(f"{out}/snapshot-{batch_id}")
        old = [p for n, p in found["batch"].items() if n <= base] + [p for n, p in found["snapshot"].items() if n < base]
        for path in old:
            target = own._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(own._jsc.hadoopConfiguration()).delete(target, True)

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _latest(spark, schema, key, _since_snapshot(_folders(spark, out)))


def completed(latest: DataFrame) -> DataFrame:
    """Progress rows with ``complete``: all announced tasks are done."""
    return latest.withColumn("complete", F.coalesce(F.col("done") == F.col("total"), F.lit(False)))


def unresolved(latest: DataFrame) -> DataFrame:
    """``(client, done, missing)`` of clients to flush at shutdown; ``missing`` is null without an announcement."""
    rows = completed(latest).where(~F.col("complete"))
    return rows.select("client", "done", (F.col("total") - F.col("done")).alias("missing"))
