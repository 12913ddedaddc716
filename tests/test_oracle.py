"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

from stockroom.plans.queries import ORACLE, QUERIES
from tests.conftest import SF01
from tests.oracle_compare import compare


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, name):
    ok, msg = compare(spark, name, SF01)
    assert ok, msg
