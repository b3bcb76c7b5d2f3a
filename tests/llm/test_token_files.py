import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lexigram.llm import token_files as t
from lexigram.llm.common import vocabulary_text
from lexigram.session import scratch_dir


@pytest.mark.parametrize("n, kinds", [(1, 1), (5, 5), (3000, 1), (5000, 40_000), (400_000, 300)])
def test_segments_round_trip(n, kinds):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % kinds).astype("<u4")
    row = t.encode_segment(ids)
    assert len(row["blocks"]) == -(-n // t.BLOCK) and np.array_equal(t.decode_segment(row), ids)
    if n == 400_000:
        shares = np.unique(ids, return_counts=True)[1] / n
        entropy = -(shares * np.log2(shares)).sum() * n / 8
        states = len(row["blocks"]) * 8 * t.LANES
        assert sum(map(len, row["blocks"])) < 1.02 * entropy + states + 100


def test_tables_keep_every_id():
    for ids in ([0] * 10_000 + [5], list(range(30_000)), [7], [1] * 3 + list(range(100, 20_000))):
        symbols, freq, bits = t.frequencies(np.array(ids, "<u4"))
        assert symbols.tolist() == sorted(set(ids)) and freq.min() >= 1 and int(freq.sum()) == 1 << bits


def test_damage_is_noticed():
    row = t.encode_segment(np.arange(5000, dtype="<u4") % 300)
    payload = bytearray(row["blocks"][0])
    payload[-3] ^= 8
    with pytest.raises(ValueError):
        t.decode_segment(row | {"blocks": [bytes(payload)]})


def test_files_read_back_in_order(spark, docs):
    texts = [(9 - i, f"Document {i} says <|endoftext|> " + "word soup; " * (i * i)) for i in range(10)]
    rows = [*texts, (20, ""), (21, None), (4, texts[5][1]), (22, "naïve 日本 " * 4000), (None, "nobody")]
    tokenizer = Tokenizer.from_str(vocabulary_text("word_bpe_49k.json"))
    want, start = [], 0
    for name, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((name, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = t.report(docs(*rows).repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    path = scratch_dir(spark, "files")
    t.write(docs(*rows), path, segment=100)
    assert spark.read.parquet(path).count() > 5
    ids = {r.start: bytes(r.ids) for r in t.read(spark, path).collect()}
    assert [(s, zlib.crc32(ids[s])) for s in sorted(ids)] == [(s, c) for _, s, _, c in want]
    assert t.report(docs((1, "a")).limit(0)).count() == 0
