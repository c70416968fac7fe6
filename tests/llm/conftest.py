import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """Documents from texts, with columns that clash with names the operators use."""

    def make(texts, ids=None):
        rows = [(i, t, None if i % 3 == 0 else "en", f"s{i % 2}", -1, "x", 7) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, part int, rank string, n_words int").repartition(3)

    return make


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables are not here")
    return SF
