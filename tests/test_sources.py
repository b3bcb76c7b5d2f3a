import gzip
from pathlib import Path

import pytest

from lexigram.operators.counts import parsed_trigram_totals, trigram_totals
from lexigram.plans.registry import QUERIES
from lexigram.session import scratch_dir
from lexigram.sources import lists, ngrams, sinks
from lexigram.sources.dependency import parse_dependency_lines


def texts(path):
    return [line for f in sorted(Path(path).rglob("part-*")) for line in f.read_text().splitlines()]


def test_ngram_lines(lines):
    rows = ["a b c\t1990\t3\t2\t1", "a b c\t1991\t4", "a b\t1990\t3", "a b c\t1990", "a b c\t1990\tx", "", "é b c d\t1\t2"]
    got = [tuple(r) for r in ngrams.parse_ngram_lines(lines(*rows)).collect()]
    assert got == [("a", "b", "c", 1990, 3), ("a", "b", "c", 1991, 4), ("é", "b", "c", 1, 2)]
    assert {r.line: r.reason for r in ngrams.rejected_ngram_lines(lines(*rows)).collect()} == {
        rows[2]: "fewer than 3 words",
        rows[3]: "fewer than 3 fields",
        rows[4]: "count is not a number",
        rows[5]: "fewer than 3 words",
    }
    totals = {(r.w1, r.w2, r.w3): r.n for r in trigram_totals(ngrams.parse_ngram_lines(lines(*rows))).collect()}
    assert totals == {("a", "b", "c"): 7, ("é", "b", "c"): 2}


def test_sequence_file_round_trip(spark, tmp_path):
    rows = [(i, f"w{i} x y\t2000\t{i}") for i in range(1, 50)]
    spark.sparkContext.parallelize(rows, 3).saveAsSequenceFile(str(tmp_path / "seq"))
    parsed = ngrams.parse_ngram_lines(ngrams.read_sequence_file(spark, str(tmp_path / "seq")))
    assert {(r.w1, r.match_count) for r in parsed.collect()} == {(f"w{i}", i) for i in range(1, 50)}


def test_text_and_gzip_input(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a b c\t1990\t3\n")
    with gzip.open(tmp_path / "b.txt.gz", "wt") as f:
        f.write("d e f\t1990\t4\n")
    both = ngrams.read_lines(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt.gz")])
    assert sorted(r.w1 for r in ngrams.parse_ngram_lines(both).collect()) == ["a", "d"]
    heads = parse_dependency_lines(ngrams.read_lines(spark, str(tmp_path))).collect()
    assert sorted(r.head for r in heads) == ["a b c", "d e f"]


def test_word_list_and_shards(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("של\nעל\nשל\n")
    assert {r.word for r in lists.read_word_list(spark, str(tmp_path / "stop.txt")).collect()} == {"של", "על"}
    files = [f"part.{i:02d}-of-99" for i in range(99)]
    assert lists.corpus_shards(files[::-1], 1) == files[:1]
    assert lists.corpus_shards(files, 10) == files[:10]
    assert lists.corpus_shards(files, 100) == files
    with pytest.raises(ValueError):
        lists.corpus_shards(files, 0)


def test_manifest_client_is_the_file_name(spark, tmp_path):
    (tmp_path / "client7.txt").write_text("ToText\thttp://h/a.pdf\nToHTML\thttp://h/b.pdf\n")
    (tmp_path / "client8.txt").write_text("ToImage\thttp://h/a.pdf\nbroken\n")
    tasks = lists.parse_manifest(lists.read_manifests(spark, str(tmp_path)))
    assert {tuple(r) for r in tasks.collect()} == {
        ("client7", "ToText", "http://h/a.pdf"),
        ("client7", "ToHTML", "http://h/b.pdf"),
        ("client8", "ToImage", "http://h/a.pdf"),
        ("client8", "broken", None),
    }


def test_key_value_and_tsv(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", 'say "c"', 0.5, 3)], "w1 string, w2 string, w3 string, prob double, n int")
    sinks.write_key_value(df, str(tmp_path / "kv"), ("w1", "w2", "w3"), ("n", "prob"))
    assert texts(tmp_path / "kv") == ['a b say "c"\t3 0.5']
    sinks.write_tsv(df.select("w1", "w2", "w3", "prob"), str(tmp_path / "tsv"))
    assert texts(tmp_path / "tsv") == ['a\tb\tsay "c"\t0.5']


def test_nulls_keep_their_place_in_key_value_lines(spark, tmp_path):
    df = spark.createDataFrame([("a", None, "c", None, 3)], "w1 string, w2 string, w3 string, prob double, n int")
    sinks.write_key_value(df, str(tmp_path / "kv"), ("w1", "w2", "w3"), ("n", "prob"))
    assert texts(tmp_path / "kv") == ["a  c\t3 "]


def test_csv_matrix_and_labels(spark, tmp_path):
    values = ", ".join(f"cast({i} + 0.5 as double) as c{i}" for i in range(1, 25))
    matrix = spark.sql(f"select 'a' as w1, 'b' as w2, {values} union all select 'c', 'd', {values}")
    sinks.write_csv(matrix, str(tmp_path / "matrix"))
    gold = spark.createDataFrame([("a", "b", "True")], "w1 string, w2 string, label string")
    sinks.merge_labelled_csv(str(tmp_path / "matrix"), str(tmp_path / "out"), gold)
    assert (tmp_path / "out").is_file()
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["w1", "w2", *[f"c{i}" for i in range(1, 25)], "result"]
    assert {(r.w1, r.c24, r.result) for r in back.collect()} == {("a", "24.5", "True"), ("c", "24.5", None)}


def test_one_file_one_header_in_order(spark, tmp_path):
    rows = [(i * 7919 % 1000, f'é, "{i}"') for i in range(1000)]
    table = spark.createDataFrame(rows, "k int, `a,b` string").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_single_csv(table, str(tmp_path / "one.csv"), ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    lines = (tmp_path / "one.csv").read_text(encoding="utf-8").splitlines()
    assert lines[0] == 'k,"a,b"' and len(lines) == 1001
    assert [int(x.split(",")[0]) for x in lines[1:]] == list(range(1000))
    back = spark.read.option("header", True).csv(str(tmp_path / "one.csv"))
    assert {(int(r.k), r["a,b"]) for r in back.collect()} == set(rows)
    sinks.write_single_csv(table.where("k < 0"), str(tmp_path / "none.csv"), ["k"])
    assert (tmp_path / "none.csv").read_text() == 'k,"a,b"\n'


def test_rejects_of_gold_and_manifest_lines(spark, lines):
    bad = lists.rejected_gold_lines(lines("a\tb\t1", "a\tb", "alone", "", None))
    assert sorted(str(r.line) for r in bad.collect()) == ["", "None", "alone"]
    tasks = spark.createDataFrame([("c", "ToText\tu"), ("c", "ToText"), ("d", "ToText\t"), ("d", None)], "client string, line string")
    got = {(r.client, r.line, r.reason) for r in lists.rejected_manifest_lines(tasks).collect()}
    assert got == {("c", "ToText", "fewer than 2 fields"), ("d", "ToText\t", "no address"), ("d", None, "fewer than 2 fields")}


def test_shard_files_are_chosen_by_name(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 10 as shard").write.partitionBy("shard").parquet(str(tmp_path / "corpus"))
    found = lists.shard_files(spark, str(tmp_path / "corpus"))
    assert [f.rsplit("=")[1] for f in found] == [str(i) for i in range(10)]
    chosen = lists.corpus_shards(found, 15)
    assert spark.read.parquet(*chosen).selectExpr("id % 10 as s").distinct().count() == 2


def test_sequence_files_are_split(spark, lines, tmp_path):
    many = spark.range(30_000).selectExpr("concat('w', id, ' b c\t2000\t1') as value").coalesce(1)
    ngrams.write_sequence_file(many, str(tmp_path / "seq"))
    back = ngrams.read_sequence_file(spark, str(tmp_path / "seq"), splits=6)
    assert back.count() == 30_000 and back.distinct().count() == 30_000
    assert len([f for f in back.inputFiles() if not f.endswith("_SUCCESS")]) >= 6


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.sql.warehouse.dir": "file:/x/spark-warehouse"}.get(key, default))

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(Session, "x")
    Session.sparkContext.master = "local[4]"
    assert scratch_dir(Session, "x").startswith("file:/x/spark-warehouse/scratch/x-")


def test_ngram_lines_are_counted_as_one_string(spark, sf_dir):
    from lexigram.plans import stand_ins

    plan = stand_ins.ngram_lines(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [key#" in plan and plan.count("Aggregate [") == 1


def test_rendered_lines_read_back(spark):
    rows = [("a", "b", "c", 1999, 3), ("a", "b", None, 2000, 1)]
    table = spark.createDataFrame(rows, "w1 string, w2 string, w3 string, year int, n bigint")
    lines = ngrams.render_ngram_lines(table, ("w1", "w2", "w3"), "year", "n")
    assert {r.value for r in lines.collect()} == {"a b c\t1999\t3", "a b\t2000\t1"}
    assert [tuple(r) for r in ngrams.parse_ngram_lines(lines).collect()] == [("a", "b", "c", 1999, 3)]


def test_parsed_trigrams_are_counted_as_one_string(spark, lines, sf_dir):
    text = ("a b c\t1990\t3", "a b c\t1991\t4", "a  c\t1990\t1", " b c d\t1990\t2", "x y z\t1990\t0", "x y z\t1991\t-1", "p q r s\t1990\t5", "bad", "a b c\t1990\tx")
    parsed = ngrams.parse_ngram_lines(lines(*text))
    assert sorted(parsed_trigram_totals(parsed).collect()) == sorted(trigram_totals(parsed).collect())
    plan = QUERIES["trigram_counts"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [gram#" in plan and "Aggregate [w1#" not in plan


def test_texts_of_sequence_files_are_packed(spark, lines, tmp_path):
    ngrams.write_sequence_file(lines("a b c\t1990\t3", "d e f\t1990\t4"), str(tmp_path / "seq"))
    back = ngrams.read_sequence_file(spark, str(tmp_path / "seq"))
    assert sorted(r.value for r in back.collect()) == ["a b c\t1990\t3", "d e f\t1990\t4"]
    assert all(f.endswith(".gz") for f in back.inputFiles())


@pytest.mark.parametrize("query", ["rejected_rows", "dep_irregular_totals"])
def test_lines_are_made_of_trigrams_counted_as_one_string(spark, sf_dir, query):
    plan = QUERIES[query](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [gram#" in plan and "Aggregate [w1#" not in plan


def test_the_store_counts_what_was_not_counted(spark, sf_dir, monkeypatch):
    from lexigram.sources.count_store import CountStore

    given, merge = [], CountStore.merge
    monkeypatch.setattr(CountStore, "merge", lambda store, counts: given.append(counts) or merge(store, counts))
    got = QUERIES["trigram_counts_merged"](spark, sf_dir)
    assert got.count() == got.select("w1", "w2", "w3").distinct().count() == QUERIES["trigram_from_text"](spark, sf_dir).count()
    assert all("Aggregate" not in g._jdf.queryExecution().optimizedPlan().toString() for g in given)
