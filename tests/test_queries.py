"""Every registered query of the engine runs; those with an oracle agree with it."""

import pytest
from conftest import rows_of

from curveloom.plans import catalog, registry  # noqa: F401


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, small, duck):
    got = registry.QUERIES[name](spark, small)
    rows = got.collect()
    if name in registry.ORACLES:
        cur = duck.execute(registry.ORACLES[name])
        names = [d[0] for d in cur.description]
        want = cur.fetchall()
        assert sorted(got.columns) == sorted(names)
        assert rows_of(got.columns, rows) == rows_of(names, want)
    else:
        assert rows


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
