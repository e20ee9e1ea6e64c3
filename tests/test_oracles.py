"""Every registered query against its check statement on the smallest scale."""

import pytest

from tests.compare import compare, oracle_connection
from tidemill.plans.catalogue import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, sf, key):
    problem, rows, _ = compare(spark, con, QUERIES[key], sf)
    assert problem == ""
    assert rows >= 0


def test_entry_module():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
