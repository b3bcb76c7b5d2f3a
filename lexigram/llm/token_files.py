"""Token ids in compressed files: static range asymmetric numeral systems over independent interleaved blocks.

A table folder holds rows in ascending ``doc_id`` order, one row per *segment*: about ``SEGMENT`` ids of whole documents with

* ``first_id``: ids before it in its part; part numbers ascend with ``doc_id``;
* ``frequencies``: the frequency table its blocks share: distinct ids with counts scaled to ``2 ** bits``, none below one;
* ``blocks``: payloads of ``BLOCK`` ids each, independent of each other, with a CRC-32 of their ids as checksum;
* ``docs``: ids and lengths of its documents. These and ``first_id`` are the checkpoints: any document is found and decoded
  from one segment alone, and segments and blocks decode in parallel.

A block deals its ids in turn to ``LANES`` coders of 64-bit state, stepped together in numpy; all push 32-bit words to one
stream, which the decoder reads forward. Payload: number of ids, lanes, final states, words.

Documents are in ``doc_id`` order, nulls first; rows that share an id are ordered by a hash of their text and follow each
other. A null or empty text holds only the end id. A damaged block raises ``ValueError`` when it is read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigram.llm.common import importable, vocabulary_text
from lexigram.llm.pieces import encoder
from lexigram.llm.words import blocks
from lexigram.session import scratch_dir

END = 1
SEGMENT, BLOCK, LANES = 1_000_000, 131_072, 1024
_LOW = np.uint64(1 << 31)
_32, _MASK32 = np.uint64(32), np.uint64(0xFFFFFFFF)

SCHEMA = (
    "part bigint, segment bigint, first_id bigint, n_ids bigint, bits int, frequencies binary, blocks array<binary>,"
    " checksums array<bigint>, doc_ids binary, doc_nulls binary, doc_lengths binary"
)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct ids in ascending order, their scaled counts (sum ``2 ** bits``) and ``bits``."""
    symbols, counts = np.unique(ids, return_counts=True)
    bits = min(24, max(14, len(symbols).bit_length() + 2))
    total = 1 << bits
    scaled = np.maximum(1, counts * total // counts.sum())
    excess = int(scaled.sum()) - total
    for at in np.argsort(-scaled, kind="stable"):
        if excess <= 0:
            break
        cut = min(excess, int(scaled[at]) - 1)
        scaled[at] -= cut
        excess -= cut
    scaled[np.argmax(scaled)] -= min(0, excess)
    return symbols, scaled.astype(np.uint64), bits


def encode_block(index: np.ndarray, freq: np.ndarray, bits: int, lanes: int = LANES) -> bytes:
    """``index``: places of the ids in the frequency table."""
    first = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    ceiling = freq << np.uint64(63 - bits)
    shift = np.uint64(bits)
    state = np.full(lanes, _LOW, np.uint64)
    words: list[np.ndarray] = []
    for start in range((len(index) - 1) // lanes * lanes, -1, -lanes):
        symbols = index[start : start + lanes]
        x, f = state[: len(symbols)], freq[symbols]
        push = x >= ceiling[symbols]
        words.append((x[push] & _MASK32).astype(np.uint32))
        x = np.where(push, x >> _32, x)
        quotient = x // f
        state[: len(symbols)] = (quotient << shift) + (x - quotient * f) + first[symbols]
    head = np.array([len(index), lanes], np.uint32)
    return head.tobytes() + state.tobytes() + (np.concatenate(words[::-1]).tobytes() if words else b"")


def decode_block(payload: bytes, freq: np.ndarray, bits: int, lookup: np.ndarray) -> np.ndarray:
    """Places of the ids in the frequency table. ``lookup``: the place for each of the ``2 ** bits`` slots."""
    n, lanes = np.frombuffer(payload, np.uint32, 2).tolist()
    state = np.frombuffer(payload, np.uint64, lanes, 8).copy()
    words = np.frombuffer(payload, np.uint32, offset=8 + 8 * lanes).astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    out, read = np.empty(n, np.int64), 0
    for start in range(0, n, lanes):
        x = state[: min(lanes, n - start)]
        slot = x & mask
        symbols = lookup[slot]
        out[start : start + lanes] = symbols
        x = freq[symbols] * (x >> shift) + slot - first[symbols]
        pull = np.flatnonzero(x < _LOW)
        x[pull] = (x[pull] << _32) | words[read : read + len(pull)]
        read += len(pull)
        state[: len(x)] = x
    if read != len(words):
        raise ValueError("a block of token ids has words left over")
    return out


def encode_segment(ids: np.ndarray) -> dict:
    symbols, freq, bits = frequencies(ids)
    index = np.searchsorted(symbols, ids)
    parts = [ids[k : k + BLOCK] for k in range(0, len(ids), BLOCK)]
    table = zlib.compress(np.concatenate([np.diff(symbols, prepend=0), freq]).astype("<u4").tobytes())
    return {
        "n_ids": len(ids),
        "bits": bits,
        "frequencies": table,
        "blocks": [encode_block(index[k : k + BLOCK], freq, bits) for k in range(0, len(ids), BLOCK)],
        "checksums": [zlib.crc32(p.tobytes()) for p in parts],
    }


def decode_segment(row: dict) -> np.ndarray:
    table = np.frombuffer(zlib.decompress(row["frequencies"]), "<u4")
    symbols, freq = np.cumsum(table[: len(table) // 2]).astype("<u4"), table[len(table) // 2 :].astype(np.uint64)
    lookup = np.repeat(np.arange(len(freq)), freq.astype(np.int64))
    parts = []
    for payload, checksum in zip(row["blocks"], row["checksums"]):
        ids = symbols[decode_block(payload, freq, row["bits"], lookup)]
        if zlib.crc32(ids.tobytes()) != checksum:
            raise ValueError("a block of token ids doesn't match its checksum")
        parts.append(ids)
    return np.concatenate(parts)


def _segment(part: int, number: int, first_id: int, names: list, found: list[bytes]) -> pa.RecordBatch:
    fields = encode_segment(np.frombuffer(b"".join(found), "<u4"))
    row = {"part": part, "segment": number, "first_id": first_id} | fields
    row["doc_ids"] = np.array([n or 0 for n in names], "<i8").tobytes()
    row["doc_nulls"] = np.array([n is None for n in names], np.uint8).tobytes()
    row["doc_lengths"] = np.array([len(x) // 4 for x in found], "<i8").tobytes()
    kinds = [("part", pa.int64()), ("segment", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.int32())]
    kinds += [("frequencies", pa.binary()), ("blocks", pa.list_(pa.binary())), ("checksums", pa.list_(pa.int64()))]
    kinds += [(c, pa.binary()) for c in ("doc_ids", "doc_nulls", "doc_lengths")]
    return pa.RecordBatch.from_pylist([row], pa.schema(kinds))


def write(docs: DataFrame, path: str, vocabulary: str = "word_bpe_49k.json", segment: int = SEGMENT) -> None:
    """Write the ids of ``docs`` (doc_id, text, ...) to the folder ``path``, which executors can reach."""
    spark = importable(docs.sparkSession)
    shared = spark.sparkContext.broadcast(vocabulary_text(vocabulary))
    end = END.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(shared.value), TaskContext.get().partitionId()
        number, first_id, names, found, held = 0, 0, [], [], 0
        for batch in batches:
            for a, b in blocks(batch.column(1), 1 << 20):
                texts = batch.column(1).slice(a, b - a)
                for name, ids in zip(batch.column(0).slice(a, b - a).to_pylist(), encode.many(texts)):
                    names.append(name)
                    found.append(ids + end)
                    held += len(ids) // 4 + 1
                    if held >= segment:
                        yield _segment(part, number, first_id, names, found)
                        number, first_id, names, found, held = number + 1, first_id + held, [], [], 0
        if names:
            yield _segment(part, number, first_id, names, found)

    rows = docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange("doc_id")
    ordered = rows.sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)`` of a folder: ids as little-endian 32-bit integers, ``start`` the ids of all documents before."""
    rows = importable(spark).read.schema(SCHEMA).parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                data = decode_segment(row).tobytes()
                names, lengths = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["doc_lengths"], "<i8")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                columns = [
                    pa.array(np.full(len(names), row["part"], np.int64)),
                    pa.array(names, mask=np.frombuffer(row["doc_nulls"], np.uint8).astype(bool)),
                    pa.array(row["first_id"] + starts),
                    pa.array([data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "start", "ids"])

    decoded = rows.mapInArrow(run, "part bigint, doc_id bigint, start bigint, ids binary")
    placed = decoded.join(F.broadcast(before), "part")  # one row per written part
    return placed.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "ids")


def report(docs: DataFrame) -> DataFrame:
    """Write the ids, read the files back, and sum up each document."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "token-files")
    write(docs, path)
    n = F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens")
    return read(spark, path).select("doc_id", "start", n, F.crc32("ids").alias("ids_crc32"))
