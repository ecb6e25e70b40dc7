"""Every registered query against its DuckDB oracle on the smallest driver data set."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle import compare, duck
from tracelake.plans.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_library_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    n, problems = compare(df, con, entry.oracle_sql()[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["timestamp", "level", "component", "message"]
    assert df.count() > 0
