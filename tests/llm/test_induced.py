"""Sorted suffixes and common prefixes against sorting in memory."""

import random

import numpy as np
import pytest

from lexigram.llm import induced


def check(strings, cap):
    text, starts = induced.joined(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]))
    pos, lcp = induced.sorted_suffixes(text, starts, cap)
    want = sorted((s[i:], k, int(starts[k]) + 1 + i) for k, s in enumerate(strings) for i in range(len(s)))
    assert pos.tolist() == [at for _, _, at in want]
    for (a, *_), (b, *_), met in zip(want, want[1:], lcp[1:]):
        same = next((m for m in range(min(len(a), len(b), cap)) if a[m] != b[m]), min(len(a), len(b), cap))
        assert met == same


@pytest.mark.parametrize("queued", [0, 100, 2**20], ids=["on disk", "both", "in memory"])
@pytest.mark.parametrize("letters", [1, 2, 3, 30, 256])
def test_random_strings(monkeypatch, queued, letters):
    monkeypatch.setattr(induced, "QUEUED", queued)
    monkeypatch.setattr(induced, "LARGE", 50)
    rng = random.Random(letters)
    for turn in range(40):
        monkeypatch.setattr(induced, "PIECE", (1, 7, 1000)[turn % 3])
        first = 0 if letters == 256 else 97
        strings = [bytes(first + rng.randrange(letters) for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(1, 8))]
        check(strings + strings[: turn % 3], (3, 50)[turn % 2])


def test_one_long_run_and_one_symbol():
    check([b"a" * 300, b"b", b"ab" * 100], 50)
    check([b"z"], 50)
