"""Input views: large joins are dealt out by their key, with the same rows."""

import pytest

from traitlab.sources import fixtures


@pytest.mark.parametrize("name", ["user_installs", "user_installs_push"])
def test_large_joins_are_dealt_out_by_rows(ctx001, name):
    tables = ctx001.tables
    plain, dealt = fixtures.fixture(tables, name), fixtures.fixture(tables, name, rows_per_partition=500)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan(plain)
    assert "RepartitionByExpression [o_orderkey" in plan(dealt) and "RepartitionByExpression [l_orderkey" in plan(dealt)
    n = fixtures._dealt_out(tables, name, 500)["lineitem"].rdd.getNumPartitions()
    assert n >= tables["lineitem"].count() / 500
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(dealt) == rows(plain)
