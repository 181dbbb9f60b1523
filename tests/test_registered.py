"""Every registered query agrees with its SQL twin."""

import pytest

from leadframe.plans import QUERIES, TWINS
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def twin_db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, twin_db, name):
    agrees, message, _ = compare(spark, twin_db, sf_dir, name)
    assert agrees, message


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(TWINS) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
