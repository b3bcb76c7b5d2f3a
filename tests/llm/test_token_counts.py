import itertools

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lexigram.llm import token_counts as t
from lexigram.llm.common import vocabulary_text
from tests.llm.test_words import random_texts

ODD = [
    "", " ", "a  b", "  \n x \t y", "don't  we've 's 'S ''s '' 'r 're 'rx 'l 'll'll 'v've's's", "\x1c x \x1c\xa0　 a", "'", "'r",
    "x <|endoftext|> y<|endoftext|>z  <|endoftext|>", "日本語 テスト 😀 👍🏽", "ﬁ x² ½ ①", " " * 300 + "y", "x" * 700, "--------" * 40,
    "12345 67,89.0", "\r\n \r\n a",
]


@pytest.fixture(scope="module")
def machine():
    vocabulary = vocabulary_text("byte_bpe_50k.json")
    return t.Merger(vocabulary), t.character_classes(), t.special_tokens(vocabulary), Tokenizer.from_str(vocabulary)


def test_counts_are_the_library_s(machine):
    merger, classes, special, tokenizer = machine
    texts = ODD + random_texts(1500, "abc drestvlm''''  \n\t.,!1é日😀AZ", 1)
    sizes, tokens = t.count(pa.array(texts), merger, classes, special)
    assert tokens.tolist() == [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x.encode()) for x in texts]


def test_chunk_maps_compose(machine):
    """Chunks of any length, entered in any state, agree with one run over everything."""
    rng = np.random.default_rng(0)
    classes = np.append(rng.choice(t.N_CLASSES, 3000, p=[0.2, 0.1, 0.2, 0.1, 0.1, 0.1, 0.05, 0.03, 0.03, 0.03, 0.03, 0.03]), t.EDGE)
    want = t.word_starts(classes, 4096)
    for chunk in (1, 2, 7, 64):
        assert np.array_equal(t.word_starts(classes, chunk), want)
    lanes = classes[:60].reshape(3, 20).T.astype(np.int16)
    maps = t.chunk_maps(lanes)
    for lane, state in itertools.product(range(3), range(t.N_STATES)):
        end = state
        for c in lanes[:, lane]:
            end = t.NEXT[end * t.N_CLASSES + c]
        assert maps[lane, state] == end


def test_long_words_are_composed_of_pieces(machine, monkeypatch):
    merger, classes, special, tokenizer = machine
    rng = np.random.default_rng(2)
    letters = lambda n, of: "".join(rng.choice(list(of), n))
    texts = ["a" * 1_000_000, "ab" * 20_000 + "c", letters(200_000, "etaoinshrdlu"), letters(30_000, "日本語é😀"), "=" * 70_001, letters(5000, "ACGT")]
    want = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert t.count(pa.array(texts), merger, classes, special)[1].tolist() == want
    monkeypatch.setattr(t, "WARM", 0)  # entry states are guessed wrong and composed right
    monkeypatch.setattr(t, "PIECE", 7)
    monkeypatch.setattr(t, "LONG", 10)
    short = [x[:3000] for x in texts]
    want = [len(e.ids) for e in tokenizer.encode_batch(short, add_special_tokens=False)]
    assert t.count(pa.array(short), merger, classes, special)[1].tolist() == want


def test_compilation_starts_anew_when_full(machine, monkeypatch):
    _, classes, special, tokenizer = machine
    small = t.Merger(vocabulary_text("byte_bpe_50k.json"))
    monkeypatch.setattr(t, "MAX_TRANSITIONS", 200)
    for seed in range(3):
        texts = random_texts(60, "abcdefgh ", seed)
        want = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert t.count(pa.array(texts), small, classes, special)[1].tolist() == want
        assert len(small.keys) == 0


def test_every_document(docs, machine):
    texts = [*ODD, None, "long text " * 30_000, ODD[4]]
    rows = t.report(docs(*enumerate(texts))).orderBy("doc_id").collect()
    want = [len(e.ids) for e in machine[3].encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in rows] == [
        (len((x or "").encode()), n, n > 1024) for x, n in zip(texts, want)
    ]
    assert t.report(docs((1, "a")).limit(0)).count() == 0
