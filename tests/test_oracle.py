"""Every e-mail query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import pytest

from mailquarry.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(name, same_as_duck):
    same_as_duck(registry.queries()[name], registry.oracle_sql()[name])


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_names_agree():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
