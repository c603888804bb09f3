"""The registered queries with SQL against DuckDB, over whole tables of the smallest scale."""

import os

import oracle
import pytest

from devdata_spark.llm import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


def test_each_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert queries.SQL.keys() <= queries.QUERIES.keys()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    assert oracle.differences(df, oracle.connect(SF_DIR), queries.SQL[name]) == []


OF_DOCUMENTS = queries.QUERIES.keys() - queries.SQL.keys() - {"op11_cross_polytope"}


@pytest.mark.parametrize("name", sorted(OF_DOCUMENTS))
def test_query_has_a_row_for_each_document(spark, name):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id")
    found = queries.QUERIES[name](spark, SF_DIR).select("doc_id")
    assert sorted(found.collect()) == sorted(documents.collect())
