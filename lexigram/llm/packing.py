"""Cost-balanced packing of documents into token sequences without padding.

A sequence costs ``LINEAR`` per token plus ``QUADRATIC`` per pair of positions a piece attends over. Documents are taken in
windows of ``WINDOW`` tokens, each within one partition, so memory is bounded and nothing is shuffled. A window of ``n``
tokens gets ``n // LIMIT`` full sequences and, for the rest, one sequence for each binary digit, whose length is a power of
two; both kinds need no padding once full. A document longer than a sequence first gives whole sequences of its own. Then
documents go, in descending cost, to the lowest-cost sequence with room for them; one that fits nowhere is cut along the
remaining room, lowest cost first. All sequences end exactly full.

Every document is its ids followed by ``END``; a null or empty text is ``END`` alone. Equal costs keep the order of rows.
Ids of documents aren't looked at: rows with a repeated or null ``doc_id`` are packed like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigram.llm.common import importable, release, vocabulary_text
from lexigram.llm.pieces import encoder
from lexigram.llm.words import blocks

LIMIT = 2048
END = 1
WINDOW = 4_000_000
LINEAR, QUADRATIC = 1.0, 1.0 / 2048

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint,"
    " sequence_tokens bigint, ids binary"
)


def cost(length: np.ndarray | int) -> np.ndarray | float:
    return LINEAR * length + QUADRATIC * length * length


def capacities(tokens: int, limit: int = LIMIT) -> list[int]:
    """Lengths of sequences that hold exactly so many tokens: full ones, then falling powers of two."""
    rest = tokens % limit
    return [limit] * (tokens // limit) + [1 << k for k in range(limit.bit_length(), -1, -1) if rest >> k & 1]


def assign(lengths: list[int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents of the given lengths."""
    pieces, sequences, rests = [], 0, []
    for doc, length in enumerate(lengths):
        for start in range(0, length - limit + 1, limit):
            pieces.append((doc, start, limit, sequences, 0))
            sequences += 1
        if length % limit:
            rests.append((length % limit, doc, length - length % limit))
    room = np.array(capacities(sum(r[0] for r in rests), limit), np.int64)
    used, spent = np.zeros_like(room), np.zeros(len(room))
    for length, doc, start in sorted(rests, key=lambda r: (-r[0], r[1])):
        while length:
            fits = room >= length
            if not fits.any():
                fits = room > 0
            at = int(np.argmin(np.where(fits, spent, np.inf)))
            take = min(length, int(room[at]))
            pieces.append((doc, start, take, sequences + at, int(used[at])))
            room[at] -= take
            used[at] += take
            spent[at] += cost(take)
            length, start = length - take, start + take
    return pieces


def _packed(doc_ids: list, ids: list[bytes], first_sequence: int) -> tuple[pa.RecordBatch, int]:
    lengths = [len(x) // 4 for x in ids]
    pieces = assign(lengths)
    size: dict[int, int] = {}
    for _, _, length, sequence, _ in pieces:
        size[sequence] = size.get(sequence, 0) + length
    columns = [
        pa.array([doc_ids[d] for d, *_ in pieces], pa.int64()),
        pa.array([start for _, start, *_ in pieces], pa.int64()),
        pa.array([length for _, _, length, *_ in pieces], pa.int64()),
        pa.array([lengths[d] for d, *_ in pieces], pa.int64()),
        pa.array([first_sequence + s for *_, s, _ in pieces], pa.int64()),
        pa.array([offset for *_, offset in pieces], pa.int64()),
        pa.array([size[s] for *_, s, _ in pieces], pa.int64()),
        pa.array([ids[d][4 * start : 4 * (start + length)] for d, start, length, *_ in pieces], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")]), len(size)


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", window: int = WINDOW) -> DataFrame:
    """Pieces of sequences with their ids (little-endian, 32 bits), from ``docs`` (doc_id, text, ...).

    ``sequence_id`` holds the partition in its upper bits, so tasks need not know of each other.
    """
    spark = importable(docs.sparkSession)
    shared = spark.sparkContext.broadcast(vocabulary_text(vocabulary))
    end = END.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value)
        sequence, names, ids, tokens = TaskContext.get().partitionId() << 40, [], [], 0
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                texts = batch.column(1).slice(a, b - a)
                for name, found in zip(batch.column(0).slice(a, b - a).to_pylist(), encode.many(texts)):
                    names.append(name)
                    ids.append(found + end)
                    tokens += len(found) // 4 + 1
                if tokens >= window:
                    out, used = _packed(names, ids, sequence)
                    sequence, names, ids, tokens = sequence + used, [], [], 0
                    yield out
                    del out
                    release()
        if names:
            yield _packed(names, ids, sequence)[0]
        del names, ids
        release()

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCHEMA)


def report(docs: DataFrame) -> DataFrame:
    crc = F.crc32("ids").alias("ids_crc32")
    return pack(docs).select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset", "sequence_tokens")
