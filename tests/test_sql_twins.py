"""Every registered query next to its SQL twin."""

import pytest

import __spark_entry__ as registered
from check_queries import connect, differences

NAMES = list(registered.queries())
TWINS = registered.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_twins_belong_to_queries():
    assert set(TWINS) <= set(NAMES)


@pytest.mark.parametrize("name", [n for n in NAMES if n in TWINS])
def test_query(spark, folder, con, name):
    assert differences(registered.queries()[name](spark, folder), con, TWINS[name]) == ""
