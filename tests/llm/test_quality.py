import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexigram.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = q.report(docs, labels).join(labels, "doc_id").toPandas()
    out = rows[rows.held_out]
    assert len(out) > 40 and (out.predicted == out.quality).mean() >= 0.95
    good, bad = (np.sort(out.score[out.quality == k].to_numpy()) for k in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() >= 0.97


def test_pairs_of_features_are_learned():
    """The label is an interaction that no sum of single features explains."""
    rng = np.random.default_rng(0)
    x = np.zeros((4000, len(q.FEATURES)))
    x[:, 2], x[:, 5] = rng.random(4000), rng.random(4000)
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = q.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95 and (2, 5) in model.pairs


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.random((500, len(q.FEATURES)))
    model = q.fit(x, (x[:, 0] > 0.4).astype(float))
    for row, score in zip(x[:20], model.score(x[:20])):
        total = model.base
        for k, table in enumerate(model.tables):
            total += table[int((model.edges[k] <= row[k]).sum())]
        for (i, j), table in zip(model.pairs, model.pair_tables):
            total += table[int((model.pair_edges[i] <= row[i]).sum()), int((model.pair_edges[j] <= row[j]).sum())]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_features_of_simple_texts():
    rows = q.measure(pa.array(["The cat. THE cat\nthe", None, "", "a!! a!! | $"], pa.string()))
    named = [dict(zip(q.FEATURES, r)) for r in rows]
    assert named[0]["log_words"] == np.log1p(5) and named[0]["line_words"] == 2.5 and named[0]["distinct_words"] == 3 / 5
    assert named[0]["upper"] == 4 / 20 and named[0]["distinct_lines"] == 1 and named[0]["top_word"] == 3 / 5
    assert named[3]["bars"] == 1 / 11 and named[3]["repeats_last_word"] == 1 / 4 and named[3]["distinct_pairs"] == 1
    assert np.isfinite(rows).all() and np.array_equal(rows[1], rows[2])


def test_odd_labels_and_documents(spark, docs):
    rng = random.Random(0)
    texts = [(i, " ".join(rng.choice(["ab", "cd$", "ef"]) for _ in range(30))) for i in range(40)]
    table = docs(*texts, (None, "x"), (77, None), (78, ""), (5, texts[5][1]))
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(40)] + [(3, None, 0), (4, 0, 1), (4, 1, 1), (None, 1, 0), (999, 1, 0), (6, 7, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    rows = q.report(table, labels).collect()
    assert len(rows) == 44 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[77].score == by_id[78].score
    learned = {r.doc_id for r in q.training_rows(table, labels).collect()}
    held = {r.doc_id for r in table.where(q.held_out()).collect()}
    assert learned and not learned & held and learned <= set(range(40))
    assert q.training_rows(table, labels, 5).count() == 5
    for some, want in ((labels.limit(0), 0.5), (labels.where("quality = 1").where("doc_id < 40"), 1.0)):
        assert q.report(table, some).first().score == pytest.approx(want, abs=0.01)
    assert q.report(table.limit(0), labels).count() == 0
    kept = q.accepted(table, labels)
    assert kept.columns == table.columns and {r.score for r in kept.collect()} == {1.5}


def test_held_out_rows_follow_the_checksum(spark):
    import zlib

    rows = spark.range(200).select(F.col("id").alias("doc_id")).select("doc_id", q.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
