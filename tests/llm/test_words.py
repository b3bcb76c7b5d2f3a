import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lexigram.llm import words as w
from lexigram.llm.common import vocabulary_text
from lexigram.llm.pieces import Encoder

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def random_texts(n, letters, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("table, pattern", [(w.ALNUM, ALNUM), (w.NOT_BLANK, NOT_BLANK)])
def test_words_are_those_of_the_pattern(table, pattern):
    texts = [None, "", " ", "a", *random_texts(300, "aB9é漢 \n\t.,\x1c\x7f"), "x" * 3000, ""]
    found = w.Words(pa.array(texts, pa.string()), table)
    per_doc = [[found.text(i).decode() for i in range(a, b)] for a, b in zip(found.first, found.first[1:])]
    assert per_doc == [pattern.findall(lower(t)) for t in texts]
    flat = [x for ws in per_doc for x in ws]
    by_word = {}
    for word, key in zip(flat, found.hashes.tolist()):
        assert by_word.setdefault(word, key) == key
    assert len(set(by_word.values())) == len(by_word)


def test_runs_stay_within_documents():
    found = w.Words(pa.array(["a b c", "a b", "b c a b c"]), w.ALNUM)
    places, hashes = w.doc_runs(found, 3)
    assert places.tolist() == [0, 5, 6, 7] and hashes[0] == hashes[3] and len(set(hashes.tolist())) == 3


def test_stretches_of_any_length(monkeypatch):
    text = pa.array([" ".join(random_texts(200, "abc", 3)), "z" * 500])
    whole = w.Words(text, w.ALNUM).hashes
    monkeypatch.setattr(w, "STRETCH", 50)
    assert np.array_equal(w.Words(text, w.ALNUM).hashes, whole)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_the_library(name):
    texts = ["", " ", "a  b", "don't 's rock'n'roll's", "x <|endoftext|> y<|startoftext|>z", "a\xa0b \xa0c d\n\xa0e f", "é*** ×a ÷."]
    texts += ["a \n b\n\n c", "…. ‘x’ «mot»", "İ ΟΔΟΣ ﬁ ½", "\x1c x \x1c", *random_texts(2000, "abc drestvlm''  \n\n\t.,!1é日😀AZ×\xa0́«*")]
    encoder = Encoder(vocabulary_text(name), max_pieces=2000)
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for size in (len(texts), 7):
        got = [x for k in range(0, len(texts), size) for x in encoder.many(pa.array(texts[k : k + size]))]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert encoder.many(pa.array([None], pa.string())) == [b""]
