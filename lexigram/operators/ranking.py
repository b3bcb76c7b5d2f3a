"""Places within groups of any size, and the smallest places that are free."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigram.session import stored


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equal keys; nulls are equal to each other."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def numbered(rows: DataFrame, keys: list[str], order: list[Column | str], place: str = "rank", size: str | None = None) -> DataFrame:
    """``rows`` with their place (from 1) within ``keys`` by ``order``, and the number of rows of their key as ``size``.

    Rows are dealt by ranges over (keys, order) and written once, so a key of any size spans as many ranges as it needs. Places
    are counted within a range; a range that carries on a key adds what the ranges before it hold of it. Only the last key
    of a range can go on in the next, so there are fewer such sums than ranges plus keys that end one, and they are broadcast.

    A null key is a key; nulls come first in ascending order. Rows that tie in ``order`` are placed in any order, so let it
    tell rows apart where that matters. Columns that begin with two underscores are taken.
    """
    ranges = stored(rows.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    ends = ranges.groupBy("__part").agg(F.max(F.struct(*keys)).alias("k")).select("k.*").distinct()
    held = ranges.select(*keys, "__part")
    held = held.join(F.broadcast(ends), _same(held, ends, keys), "left_semi")
    counts = held.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"))
    key = Window.partitionBy(*keys)
    before = key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.select(
        *keys, "__part", F.sum("__n").over(before).alias("__before"), F.sum("__n").over(key).alias("__whole")
    )
    own = Window.partitionBy("__part", *keys)
    local = ranges.withColumn("__place", F.row_number().over(own.orderBy(*order)))
    if size:
        local = local.withColumn("__size", F.count(F.lit(1)).over(own))
    spans = spans.withColumnsRenamed({k: f"__key_{i}" for i, k in enumerate(keys)} | {"__part": "__of"})
    met = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)], F.col("__part") == F.col("__of"))
    out = local.join(F.broadcast(spans), met, "left")
    columns = [F.col(c) for c in rows.columns] + [(F.col("__place") + F.coalesce("__before", F.lit(0))).cast("bigint").alias(place)]
    if size:
        columns.append(F.coalesce("__whole", "__size").cast("bigint").alias(size))
    return out.select(*columns)


def first_free(members: DataFrame, keys: list[str], place: str, k: int, rank: str | None = None) -> DataFrame:
    """``(keys, place)``: the ``k`` smallest places from 1 on that no member of the key holds, one row each, numbered from 1 as ``rank``.

    ``members`` holds distinct places per key. A member with ``m`` free places before it is the ``place - m``-th of its key;
    the ``j``-th free place is ``j`` plus the number of members with fewer than ``j`` free places before them. So counts of
    members by ``m`` below ``k`` are enough: they are summed map-side and give ``k`` numbers per key, however many
    members a key has. Keys without members have no rows here.
    """
    ordinal = numbered(members.select(*keys, place), keys, [place], "__i")
    free = (F.col(place) - F.col("__i")).alias("m")
    early = ordinal.select(*keys, free).groupBy(*keys).agg(
        *[F.count_if(F.col("m") < j).alias(f"n{j}") for j in range(1, k + 1)]
    )
    places = F.array(*[F.col(f"n{j}") + F.lit(j).cast("bigint") for j in range(1, k + 1)])
    if rank is None:
        return early.select(*keys, F.explode(places).alias(place))
    return early.select(*keys, F.posexplode(places).alias(rank, place)).withColumn(rank, F.col(rank) + 1)
