"""Every registered query against its SQL, over whole tables of the smallest scale."""

import os

import oracle
import pytest

import __spark_entry__ as driver
from workloads import catalogue

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert catalogue.QUERIES.keys() == catalogue.SQL.keys()
    assert catalogue.QUERIES.items() <= driver.queries().items()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    df = catalogue.QUERIES[name](spark, SF_DIR)
    assert oracle.differences(df, connection, catalogue.SQL[name]) == []


def test_entry_has_rows(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and "product_description" in df.columns
