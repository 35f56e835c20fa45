"""Every named query with a SQL form against that SQL, on the smallest tables. The optional part has its own test."""

import pytest
from check_oracle import compare, duck
from conftest import SMALL

from __spark_entry__ import entry
from orderloom.plans.catalog import oracle_sql, queries

SQL = oracle_sql()
# trained models and iterative name clustering run in their own tests
SLOW = {"chn_04_fit_churn", "chn_05_churn_cv", "chn_06_score_churn", "chn_07_churn_priority", "chn_08_churn_bands",
        "src_11_high_risk_export", "cus_05_resolve_batch"}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(queries()[name](spark, SMALL), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL) - SLOW))
def test_runs(spark, name):
    assert queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())
