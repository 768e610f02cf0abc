"""Every catalogue query against its SQL on DuckDB, over the whole small tables."""

import pytest

from compare import compare, connect
from __spark_entry__ import entry, oracle_sql, queries
from roadpulse.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


def test_every_query_of_the_catalogue_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))  # tests/llm has those that SQL cannot express
def test_query(spark, data, duck, name):
    text = oracle_sql()[name]
    rows, _, problems = compare(spark, duck, name, queries()[name], text, data)
    assert not problems


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "jsy" and df.count() == 83
