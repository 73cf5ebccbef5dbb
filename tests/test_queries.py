"""Every registered query against its SQL on the smallest tables."""

import pytest

from compare import compare, duck
from salescope.plans.registry import ENTRIES


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query(name, spark, small, con):
    assert compare(ENTRIES[name], spark, small, con) is None


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
