"""Clients followed to their end: complete ones are told at once, idle ones by a timer.

One row of state per client holds what is known of it; results are appended when they arise, so nothing is read back to find
out who is complete. Timers run on the messages' own time: a client without a record for ``idle`` is flushed as unresolved as
soon as the watermark (the latest message, less ``delay``) has passed that moment, whether or not it sends anything again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from lexigram.streaming.tasks import decoded

#: The state store that timers need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTCOME = "client string, status string, done long, missing long"
KNOWN = "done long, total long, timer long, status string"
OPEN, COMPLETE, UNRESOLVED = "open", "complete", "unresolved"


class Follower(StatefulProcessor):
    """State and timer of a client. ``idle``: milliseconds without a record after which it is flushed."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", KNOWN)

    def _outcome(self, client: str, done: int, total: int, status: str) -> pd.DataFrame:
        row = (client, status, done, None if total < 0 else total - done)
        return pd.DataFrame([row], columns=["client", "status", "done", "missing"]).astype({"missing": "Int64"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        done, total, timer, status = self.known.get() if self.known.exists() else (0, -1, -1, OPEN)
        last = timer + 1 - self.idle
        for part in rows:
            done += int(part["is_new"].sum())
            announced = part["total"].max()
            total = total if pd.isna(announced) else max(total, int(announced))
            last = max(last, int(part["at"].max()))
        if timer >= 0:
            self.handle.deleteTimer(timer)
        if done == total:
            timer, new = -1, COMPLETE
        else:
            timer, new = last + self.idle - 1, OPEN  # a timer fires once the watermark is beyond it
            self.handle.registerTimer(timer)
        self.known.update((done, total, timer, new))
        if new == COMPLETE and status != COMPLETE:
            yield self._outcome(key[0], done, total, COMPLETE)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        done, total, _, status = self.known.get()
        if status == OPEN:
            self.known.update((done, total, -1, UNRESOLVED))
            yield self._outcome(key[0], done, total, UNRESOLVED)

    def close(self) -> None:
        pass


def with_state_store(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def outcomes(messages: DataFrame, idle_seconds: int, delay: str) -> DataFrame:
    """``(client, status, done, missing)``: ``complete`` once all announced tasks are done, ``unresolved`` once a client that is not
    complete has been idle; ``missing`` is null without an announcement.

    A client that goes on after its flush is followed further: it can end as complete, or be flushed again. Repeated records
    count once, but each of them, and each record of an open task, is a sign of life: it is the last one that the hour counts from.
    Records without a time say nothing of their arrival and are left out, as are those later than ``delay``.
    """
    with_state_store(messages.sparkSession)
    rows = decoded(messages.withWatermark("ts", delay)).where(F.col("reason").isNull() & F.col("ts").isNotNull())
    is_control = F.col("total").isNotNull()
    finished = rows.where(is_control | (F.get("parts", F.lit(2)) != "")).select(
        "client",
        is_control.alias("is_control"),
        F.when(is_control, F.col("content")).otherwise(F.get("parts", F.lit(1))).alias("task"),
        "total",
        "ts",
        F.unix_millis("ts").alias("at"),
    )
    once = finished.dropDuplicates(["client", "is_control", "task"])
    told = once.select("client", (~F.col("is_control")).alias("is_new"), "total", "ts", "at")
    alive = rows.select("client", F.lit(False).alias("is_new"), F.lit(None).cast("bigint").alias("total"), "ts", F.unix_millis("ts").alias("at"))
    return told.unionByName(alive).groupBy("client").transformWithStateInPandas(
        statefulProcessor=Follower(1000 * idle_seconds), outputStructType=OUTCOME, outputMode="Append", timeMode="EventTime"
    )
