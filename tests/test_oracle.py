"""Every named query against its SQL check on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

from abacarium.plans.library import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    query = QUERIES[name]
    df = query(spark, SF)
    if query.check is None:
        assert df.count() > 0
    else:
        assert differences(df, duck, query.check) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
