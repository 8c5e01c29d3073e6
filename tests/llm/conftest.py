import os

import pytest


@pytest.fixture
def documents(spark):
    """Documents from (id, text, source) or (id, text) rows, with a column whose name clashes."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "x", 0) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, id string, node int"
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def small_documents(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    return spark.read.parquet(path)
