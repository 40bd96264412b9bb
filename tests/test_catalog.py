import pytest
from check_oracles import connect, difference

import __spark_entry__ as driver
from millrace.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", driver.oracle_sql())
def test_query_equals_its_sql(name, spark):
    assert difference(spark, connect(FOLDER), FOLDER, name) is None


def test_every_query_of_the_catalog_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["event_id", "line"] and df.count() > 0
