"""Every registered query against its SQL, over the whole test tables."""

import pytest

import __spark_entry__ as catalogue
from checks.compare import digest, oracle_connection, type_differences
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(catalogue.queries()) and set(ORACLES) <= set(catalogue.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    assert rows
    assert sorted(df.columns) == sorted(names)
    assert type_differences(df, result) == []
    assert len(rows) == len(expected)
    assert digest(df.columns, rows) == digest(names, expected)


def test_entry_runs(spark):
    assert {r["severity"]: r["records"] for r in catalogue.entry(spark).collect()} == {
        "CRITICAL": 412, "HEALTHY": 541, "WARNING": 47,
    }
