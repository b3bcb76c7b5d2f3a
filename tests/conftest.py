import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lexigram.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, memory="8g", shuffle_partitions=8, shared=shared)
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def lines(spark):
    """Strings as a ``value`` column."""
    return lambda *rows: spark.createDataFrame([(r,) for r in rows], "value string")


@pytest.fixture
def trigrams(spark):
    """``"w1 w2 w3": n`` as a trigram table."""
    return lambda counts: spark.createDataFrame(
        [(*gram.split(), n) for gram, n in counts.items()], "w1 string, w2 string, w3 string, n bigint"
    )
