"""Every named query beside its DuckDB SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_oracles import connect, differences
from oracles import ORACLES
from tidemark.plans.registry import QUERIES as OWN

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(OWN) - set(ORACLES) == {"churn_fit", "churn_score"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["churn_fit", "churn_score"])
def test_fitted_queries_run(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 150
