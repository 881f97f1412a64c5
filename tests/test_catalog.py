"""Every query of the catalog gives the rows of its SQL."""

import pytest

from rillflow.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, sf_dir, same_rows, name):
    same_rows(catalog.QUERIES[name](spark, sf_dir), catalog.ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
