"""Every query with SQL oracle equals DuckDB on sf0.001 (multiset of rows)."""

import pytest

from tests.conftest import SF_SMALL
from tests.harness import compare
from zonewatch.plans.catalog import QUERIES

KEYS = sorted(k for k, e in QUERIES.items() if e.oracle is not None)


@pytest.mark.parametrize("name", KEYS)
def test_oracle(spark, duck_small, name):
    r = compare(spark, duck_small, name, SF_SMALL)
    assert r["ok"], r


def test_every_query_has_an_oracle():
    assert KEYS == sorted(QUERIES)
