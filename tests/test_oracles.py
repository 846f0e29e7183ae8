"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import pytest
from compare import difference
from helpers import SMALL

from tidemill.plans import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert name in ORACLES, "every query has its SQL"
    assert difference(spark, SMALL, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() == 5
