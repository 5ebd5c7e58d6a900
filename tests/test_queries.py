"""Every registered query beside its SQL oracle, on the smallest tables."""

import pytest

from checks.compare import DATA, difference, oracle_connection
from checks.oracle import oracle_sql
from checks.queries import queries

from .test_plans import LEARNED

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_every_deterministic_query_has_an_oracle():
    assert set(queries()) - set(oracle_sql()) == LEARNED
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, oracle, name):
    got = queries()[name](spark, SF).toPandas()
    assert difference(got, oracle.execute(oracle_sql()[name]).df()) is None
