import pytest

DOCS = "doc_id bigint, text string"


@pytest.fixture
def docs(spark):
    """``(id, text)`` pairs as documents with columns whose names the operators use themselves."""

    def make(*rows):
        table = spark.createDataFrame(list(rows), DOCS)
        return table.selectExpr("*", "'x' as items", "1.5 as score", "7 as n_words", "'y' as blob", "'z' as spans", "1 as part")

    return make


@pytest.fixture
def plain(spark):
    return lambda *rows: spark.createDataFrame(list(rows), DOCS)
