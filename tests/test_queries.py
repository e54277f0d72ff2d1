"""Every registered query that has a DuckDB counterpart gives the same rows."""

import pytest

from tickloom.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(agree, name):
    assert agree(name, registry.queries()[name], registry.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
