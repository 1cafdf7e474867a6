"""Every query of the library against its SQL on the smallest tables."""

import pytest

from loam import plans
from tests.oracle import assert_same


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_same_rows_as_sql(spark, sf, name):
    assert_same(plans.QUERIES[name](spark, sf), plans.SQL[name], sf)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_gives_rows(spark, sf, name):
    assert plans.QUERIES[name](spark, sf).count() >= 1


def test_entry_module_registers_all():
    import __spark_entry__ as entry

    assert set(plans.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry.__doc__
