"""Every registered query of the core against its SQL, or at least run."""

import pytest
from compare import connect, spark_rows, sql_rows

from citelake.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert spark_rows(df) == sql_rows(con, ORACLES[name])
    else:
        assert len(df.collect()) > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_point_without_llm(monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "citelake.llm", None)
    assert set(entry.queries()) == set(QUERIES)
    assert set(entry.oracle_sql()) == set(ORACLES)
