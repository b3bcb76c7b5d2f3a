"""The stages one by one against brute force on the small tables."""

import numpy as np
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from lexigram.llm import secrets
from lexigram.llm.common import vocabulary_text
from lexigram.llm.queries import LLM_ORACLE, LLM_QUERIES
from lexigram.session import stored
from tests.llm.test_minhash import brute as classes
from tests.llm.test_words import ALNUM, lower

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    after = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        after.append(docs)
    accepted, single, clean, masked, packed = after
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(d.columns == columns for d in after[:4])
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id: r.text for r in accepted.collect()}
    assert np.mean([i in kept for i, v in quality.items() if v == 1]) > 0.97
    assert np.mean([i in kept for i, v in quality.items() if v == 0]) < 0.3
    left = {r.doc_id: r.text for r in single.collect()}
    assert set(left) == set(classes(list(kept.items())).values())
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        ws = ALNUM.findall(lower(r.text))
        windows |= {tuple(ws[k : k + 10]) for k in range(max(1, len(ws) - 9))}

    def leaked(text):
        ws = ALNUM.findall(lower(text))
        return any(tuple(ws[k : k + 10]) in windows for k in range(len(ws)))

    unleaked = {r.doc_id: r.text for r in clean.collect()}
    assert set(unleaked) == {i for i, t in left.items() if not leaked(t)} != set(left)
    texts = {r.doc_id: r for r in masked.collect()}
    assert set(texts) == set(unleaked) and any("[" in r.text for r in texts.values())
    again = secrets.report(masked).collect()
    assert sum(r.n_assign + r.n_access + r.n_hex for r in again) == 0
    assert all(r.n_chars == len(r.text) for r in texts.values())
    tokenizer, whole = Tokenizer.from_str(vocabulary_text("byte_bpe_50k.json")), {}
    for r in sorted(packed.collect(), key=lambda r: r.start):
        whole[r.doc_id] = whole.get(r.doc_id, []) + np.frombuffer(r.ids, "<u4").tolist()
    assert whole == {i: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for i, r in texts.items()}


def test_everything_is_registered():
    names = __spark_entry__.queries().keys()
    assert {n.split("_")[0] for n in LLM_QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert names >= {*LLM_QUERIES, "pipeline"} and LLM_ORACLE.keys() <= LLM_QUERIES.keys()
