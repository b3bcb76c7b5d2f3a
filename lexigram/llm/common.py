"""What the operators of this folder share: reading, Arrow maps and tokenizer files."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it."""
    paths = spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT).split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def boxed(docs: DataFrame) -> DataFrame:
    """``(doc, text)``: whole rows in one column, out of the way of the columns that an operator adds."""
    return docs.select(F.struct(*docs.columns).alias("doc"), "text")


def release() -> None:
    """Give memory that a task has freed back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``make`` over Arrow batches, each on its own."""
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := make(batch)) is not None:
                yield out
        release()

    return df.mapInArrow(run, schema)


#: Words of 64 bits in the filter of ``likely_in``: one megabyte, whatever the input.
FILTER_WORDS = 2**17


def _places(column: str) -> list[Column]:
    """Two bits of the filter for a value."""
    return [F.pmod(F.xxhash64(column, F.lit(k)), F.lit(64 * FILTER_WORDS)) for k in (1, 2)]


def likely_in(wanted: DataFrame, column: str) -> Column:
    """A condition on ``column`` that holds for every value of ``wanted`` (one column of that name) and few others.

    A Bloom filter of fixed size: it keeps most rows out of a shuffle while ``wanted`` has up to some hundred thousand values;
    with more it lets more rows pass and the plan stays the same. Give ``wanted`` as a stored table.
    """
    bits = wanted.select(F.explode(F.array(*_places(column))).alias("p"))
    word = F.expr("shiftleft(1L, cast(p % 64 as int))")
    rows = bits.groupBy((F.floor(F.col("p") / 64)).alias("at")).agg(F.bit_or(word).alias("bits")).collect()
    words = [0] * FILTER_WORDS
    for row in rows:
        words[row["at"]] = row["bits"]
    table = wanted.sparkSession.createDataFrame([(words,)], "words array<bigint>").scalar()
    found = [
        F.getbit(F.get(table, F.floor(p / 64).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1 for p in _places(column)
    ]
    return found[0] & found[1]


def vocabulary_text(name: str) -> str:
    """The JSON file of a public tokenizer; ``name`` is a file name of the installed package or a path."""
    if os.path.sep not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Path(name).read_text(encoding="utf-8")
