from __future__ import annotations

import pytest

from dealspark.llm.common import ship, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    ship(spark)
    return table(spark, SF, "documents")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) rows, spread over tasks, with extra columns whose names the operators use inside."""
    ship(spark)

    def of(rows):
        rows = [(i, t, "x", 1, -5) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, block string, n_words int, kept int").repartition(3)

    return of


@pytest.fixture(scope="session")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
