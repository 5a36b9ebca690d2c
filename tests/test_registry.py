import pytest

from tests import oracle_check
from tests.conftest import SMALL
from trustmart.plans import registry

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SMALL)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_statement(spark, con, name):
    same, _, note = oracle_check.compare(spark, con, SMALL, QUERIES[name], ORACLES[name])
    assert same, note


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 80
