"""Every registered query on the smallest tables, against its SQL where it has some."""

import pytest
from check import compare, connect

from flowvec import plans

QUERIES, ORACLES = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, con, folder, name):
    ok, message = compare(spark, con, folder, QUERIES[name], ORACLES[name])
    assert ok, message


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, con, folder, name):
    ok, message = compare(spark, con, folder, QUERIES[name], None)
    assert ok and message != "rows only: 0", message


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
