import pytest

from lexigram.llm import licences as li
from tests.llm.test_words import ALNUM, lower

TEXTS = [
    "Some words. Licensed under CC BY-NC 4.0. All rights reserved, all RIGHTS reserved.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Released under the MIT License",
    "the mit and the licence under which nothing is released",
    "Permission is hereby granted free of any charge, to any person obtaining one copy of this software and associated"
    " documentation files (the Software), to deal in the Software without restriction.",
    "",
    None,
    "gpl " * 5000 + "Licensed under the Apache License, Version 2.0" + " end" * 5000,
    "Released under the MIT License",
]


def brute(text):
    ws = ALNUM.findall(lower(text))
    found = [(k, v) for p, v in li.BASE.items() for k in range(len(ws)) if ws[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in found]
    return len(ws), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({v for _, v in found}))


def test_base_phrases_against_brute_force_and_labels(docs):
    rows = li.report(docs(*enumerate(TEXTS))).orderBy("doc_id").collect()
    assert [tuple(r)[1:6] for r in rows] == [brute(t) for t in TEXTS]
    labels = ["cc-by,cc-by-nc-4.0,reserved", "gpl,gpl-3.0", "mit", "", "mit", "", "", "apache-2.0", "mit"]
    assert [r.labels for r in rows] == labels
    assert all((r.score > 0) == bool(r.labels) and 0 <= r.score <= 1 for r in rows) and rows[2].score == 1
    assert 0.75 <= rows[4].score < 1


def test_places(docs):
    row = li.scan(docs((1, "x y Released under the MIT License z"))).first()
    assert [tuple(m) for m in row.matches] == [("mit", 2, 7, 1.0)] and row.n_words == 8 and row.base == []


def test_frequent_words_are_no_anchors(docs):
    corpus = docs(*[(i, "released software under the law" + " mit" * (i % 2)) for i in range(50)])
    frequency, n = li.document_frequencies(corpus)
    assert n == 50 and sorted(set(frequency.values())) == [0, 25, 50]
    index = li.Index(li.TEMPLATES, frequency, n, anchors=2)
    anchors = {w for t, (ws, hs) in enumerate(index.words) for w, h in zip(ws, hs.tolist()) if (t, ws.index(w)) in index.postings.get(h, [])}
    assert b"license" in anchors and b"under" not in anchors


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_small_tables(docs, rows):
    table = docs(*rows) if rows else docs((1, "a")).limit(0)
    assert li.report(table).count() == len(rows)
