"""Every registered query of the reference's operators against its SQL, on the small tables."""

import pytest

from tests.conftest import DATA, duck, same
from tickloom.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(f"{DATA}/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, small, name):
    same(QUERIES[name](spark, small), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
