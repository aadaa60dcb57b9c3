"""Every registered query against its SQL on the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name in ORACLES:
        assert difference(got, con.execute(ORACLES[name]).df()) is None
    else:
        assert len(got) > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def test_every_oracle_has_a_query():
    from checks.oracles import ORACLES as every

    assert set(every) <= set(QUERIES)
