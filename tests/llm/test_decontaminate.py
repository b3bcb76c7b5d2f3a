import hashlib

from lexigram.llm import decontaminate as d
from tests.llm.test_words import ALNUM, lower

ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "short ITEM"), (3, None), (4, "..."), (None, "lost")]
ITEMS += [(12, "one two three four five six seven eight nine ten"), (2, "short item")]


def brute(texts, n=10):
    windows = {}
    for item, text in ITEMS:
        ws = ALNUM.findall(lower(text))
        size = min(n, len(ws))
        for k in range(len(ws) - size + 1 if size and item is not None else 0):
            windows.setdefault(tuple(ws[k : k + size]), set()).add(str(item))
    out = []
    for text in texts:
        ws, hit, items = ALNUM.findall(lower(text)), set(), set()
        for a in range(len(ws)):
            for b in range(a + 1, min(len(ws), a + n) + 1):
                if found := windows.get(tuple(ws[a:b])):
                    hit.update(range(a, b))
                    items |= found
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((len(ws), len(hit), len(items), digest, bool(hit)))
    return out


TEXTS = [
    "so one two, three four FIVE six seven eight nine ten eleven - twelve and more",
    "one two three four five six seven eight nine",
    "a short item, and a short item short",
    "",
    None,
    "x " * 3000 + "short. item" + " y" * 3000,
    "a short item, and a short item short",
]


def test_every_document_against_brute_force(spark, docs):
    table = docs(*enumerate(TEXTS))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for most in (d.MAX_WINDOWS, 2):  # all windows in one broadcast, and in several blocks
        found = d.scan(table, items, max_windows=most).orderBy("doc_id")
        rows = found.select("n_words", d.n_hit().alias("n"), "items", "ranges").collect()
        got = [
            (r.n_words, r.n, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.ranges)) for r in rows
        ]
        assert got == brute(TEXTS)
    report = d.report(table, items).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in report] == brute(TEXTS)


def test_documents_or_spans_go(spark, docs):
    table = docs(*enumerate(TEXTS))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    clean = d.clean_documents(table, items)
    assert clean.columns == table.columns and sorted(r.doc_id for r in clean.collect()) == [1, 3, 4]
    assert {(r["items"], r.n_words) for r in clean.collect()} == {("x", 7)}
    cut = {r.doc_id: r.text for r in d.cut_spans(table, items).collect()}
    assert cut[0] == "so  and more" and cut[2] == "a , and a  short" and cut[1] == TEXTS[1] and cut[4] is None


def test_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert d.report(docs((1, "a")).limit(0), items).count() == 0
    assert [tuple(r)[1:3] for r in d.report(docs((1, "a")), items.limit(0)).collect()] == [(1, 0)]


def test_passage_of_very_many_items_is_one_window(spark, docs):
    stock = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(k, stock if k % 3 else f"item {k} of its own") for k in range(9_000)], "item_id bigint, text string")
    listed = d.item_windows(items)
    assert listed.count() == 9_000 and d.distinct_windows(listed).where("size = 10").count() == 1
    table = docs((1, f"so {stock} it goes"), (2, f"again {stock}"), (3, "clean"), (None, "item 3 of its own"))
    got = {r.doc_id: r for r in d.report(table, items).collect()}
    names = ",".join(sorted(str(k) for k in range(9_000) if k % 3))
    assert all(got[k].items_sha256 == hashlib.sha256(names.encode()).hexdigest() and got[k].n_items == 6_000 for k in (1, 2))
    assert not got[3].contaminated and (got[None].n_items, got[None].n_hit) == (1, 5)


def test_windows_with_one_hash_keep_their_items(spark):
    rows = [("a", 1, 7, b"x"), ("b", 1, 7, b"y"), ("c", 1, 7, b"y"), ("d", 2, 7, b"x y")]
    listed = spark.createDataFrame(rows, "item string, size int, key bigint, words binary")
    windows = d.distinct_windows(listed)
    assert sorted((r.size, bytes(r.words), r.variant) for r in windows.collect()) == [(1, b"x", 1), (1, b"y", 2), (2, b"x y", 3)]
    found = spark.createDataFrame([(1, [(7, 2)]), (2, [(7, 1), (7, 3)]), (3, [])], f"doc_id bigint, windows {d.FOUND}")
    got = {r.doc_id: r["items"] for r in d._with_items(found, listed, windows).collect()}
    assert got == {1: ["b", "c"], 2: ["a", "d"], 3: []}
