"""Every query against its SQL twin on the smallest tables."""

import pytest

from catalog.queries import CATALOG
from tests.twins import connect, differences


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_agrees_with_sql(spark, duck, small, name):
    assert differences(spark, duck, small, name) == []
