"""Every query against its SQL, over whole tables."""

import pytest

from __spark_entry__ import entry
from checks.compare import differences, views
from checks.oracle import ORACLE
from lexigram.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    return views("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got) > 0
    assert differences(got, duck.execute(ORACLE[name]).df()) == ""


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["w1", "w2", "w3", "prob"] and rows.count() > 0
