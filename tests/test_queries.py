import pytest

import __spark_entry__ as driver
from catalog import ENTRIES
from oracles.compare import connect, difference
from tests.conftest import FOLDER


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_same_rows_as_the_sql(spark, connection, name):
    function, sql = ENTRIES[name]
    assert difference(spark, connection, function, sql, FOLDER) is None


def test_entry(spark):
    result = driver.entry(spark)
    assert result.count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
