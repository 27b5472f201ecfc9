import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def docs(spark):
    from edge_docs import edge_docs
    return edge_docs(spark).cache()


@pytest.fixture(scope="session")
def none(spark):
    from edge_docs import empty_docs
    return empty_docs(spark)


@pytest.fixture(scope="session")
def corpus(spark):
    """The smallest documents table, and its rows."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
