"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from oracles.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


# The text operations have tests of their own, beside them.
OWN = sorted(n for n in entry.queries() if not n.startswith("op") and n != "pipeline")


def test_every_query_has_sql():
    assert set(OWN) == {n for n in entry.oracle_sql() if n in OWN}


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert differences(con, df, entry.oracle_sql()[name]) == []
