"""Every registered query against its independent SQL, on the smallest test tables."""

import pytest

from oracle.compare import differences, open_duckdb
from oracle.statements import oracle_sql
from shelfline.plans.registry import PLANS, queries

from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    connection = open_duckdb(SMALL)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(PLANS)


@pytest.mark.parametrize("key", sorted(PLANS))
def test_query_matches_oracle(spark, duck, key):
    rows, found = differences(spark, duck, queries()[key], oracle_sql()[key], SMALL)
    assert found == []
    assert rows > 0 or key == "current_promotions"
