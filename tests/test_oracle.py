"""Every registered query against its DuckDB oracle at sf0.01: row count, column
names and an order-insensitive hash of the values."""

import pytest

import __spark_entry__ as E
from cartloom.plans.queries import oracle_queries, spark_queries
from tests.conftest import SF01
from tools.oracle_check import digest, duck, type_classes_duck, type_classes_spark

NAMES = sorted(spark_queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(oracle_queries()) == set(spark_queries())
    assert set(spark_queries()) <= set(E.queries()) and set(oracle_queries()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = spark_queries()[name](spark, SF01)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_queries()[name])
    drows = cur.fetchall()
    dcols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert type_classes_spark(df) == type_classes_duck(con, oracle_queries()[name])
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["run_date", "total", "created", "modified", "total_modified"]
    assert df.count() > 0
