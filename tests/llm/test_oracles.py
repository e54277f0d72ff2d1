"""Every corpus query that has a DuckDB counterpart gives the same rows."""

import pytest

from tickloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(agree, name):
    assert agree(name, queries.queries()[name], queries.oracle_sql()[name])
