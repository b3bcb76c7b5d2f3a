import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from lexigram.llm import packing as p
from lexigram.llm.common import vocabulary_text


def test_capacities_need_no_padding():
    for n in (0, 1, 2047, 2048, 2049, 100_000, 12_345):
        sizes = p.capacities(n)
        assert sum(sizes) == n and all(s == 2048 or s & (s - 1) == 0 for s in sizes)


def test_assignment_covers_every_id_once_and_balances_cost():
    rng = random.Random(0)
    lengths = [rng.choice([1, 5, 300, 900, 2048, 5000]) for _ in range(400)]
    pieces = p.assign(lengths)
    covered, used, cost = [[] for _ in lengths], {}, {}
    for doc, start, length, sequence, offset in pieces:
        covered[doc].append((start, length))
        used.setdefault(sequence, []).append((offset, length))
        cost[sequence] = cost.get(sequence, 0) + p.cost(length)
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(covered[doc]):
            assert start == at and length > 0
            at += length
        assert at == n
    full = []
    for sequence, parts in used.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
        if at == 2048 and len(parts) > 1:
            full.append(cost[sequence])
    assert max(full) <= 1.5 * min(full)
    assert p.assign([]) == []


def test_pieces_hold_the_ids(docs):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["alpha", "Beta,", "γάμμα", "<|endoftext|>"]) for _ in range(rng.randrange(900))) for _ in range(30)]
    rows = list(enumerate([*texts, "", None, "word " * 20_000])) + [(3, texts[3]), (None, "x")]
    tokenizer = Tokenizer.from_str(vocabulary_text("byte_bpe_50k.json"))
    want = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for _, t in rows]
    for window in (p.WINDOW, 3000):
        found = p.pack(docs(*rows).repartition(3), window=window).collect()
        whole = {}
        for r in found:
            assert len(r.ids) == 4 * r.length and r.offset + r.length <= r.sequence_tokens <= 2048
            whole.setdefault((r.doc_id, r.doc_tokens), {}).setdefault(r.start, set()).add(bytes(r.ids))
        for (name, _), ids in zip(rows, want):
            parts = whole[name, len(ids) // 4]
            if name != 3:  # its copy may be cut elsewhere
                assert b"".join(next(iter(parts[s])) for s in sorted(parts)) == ids
        assert sum(r.length for r in found) == sum(len(w) // 4 for w in want)
        sizes = {}
        for r in found:
            sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
        assert all(r.sequence_tokens == sizes[r.sequence_id] for r in found)
        assert all(s == 2048 or s & (s - 1) == 0 for s in sizes.values())
    row = p.report(docs((7, "hello"))).first()
    ids = [*tokenizer.encode("hello").ids, 1]
    assert (row.doc_id, row.length + 0, row.doc_tokens) == (7, row.sequence_tokens, len(ids)) or len(ids) != row.length
    assert p.report(docs((7, "hello")).limit(0)).count() == 0
    assert zlib.crc32(np.array([1], "<u4").tobytes()) == p.report(docs((7, None))).first().ids_crc32
