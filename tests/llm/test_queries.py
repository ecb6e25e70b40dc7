"""Registered queries of the package against their DuckDB SQL, and their result columns."""

import pytest

from oracle import compare, duck
from tracelake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    n, problems = compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert n and not problems, problems


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_columns_are_flat_and_named(spark, name):
    df = QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns) and name.startswith("op")
