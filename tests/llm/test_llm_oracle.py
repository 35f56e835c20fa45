"""The queries of the training-data operators against their SQL, on the smallest tables."""

import pytest
from check_oracle import compare, duck
from conftest import SMALL

import corpus_pipeline
from orderloom.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
