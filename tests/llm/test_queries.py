"""Every registered query against its SQL on the smallest tables, and the shape of those without SQL."""

import pytest

from panelrank.llm import queries
from tests.helpers import assert_same


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf, duck, name):
    assert_same(queries.QUERIES[name](spark, sf), duck.sql(queries.ORACLES[name]))


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
