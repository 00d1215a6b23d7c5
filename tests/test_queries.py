"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    own = set(driver.queries()) - set(driver.LLM_QUERIES)
    assert own - set(driver.oracle_sql()) == {"stream_ttl"}


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_matches_sql(spark, con, name):
    df = driver.queries()[name](spark, SF)
    assert differences(df, con, driver.oracle_sql()[name]) is None


def test_processing_time_memory_gives_rows(spark):
    assert driver.queries()["stream_ttl"](spark, SF).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
