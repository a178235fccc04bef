"""Queries that SQL can express, next to their SQL."""

import pytest

from checks.compare import digest, oracle_connection, type_differences
from pulsegrid.llm.queries import ORACLES, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    sf = sf_dir.replace("0.001", "0.01")
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    result = oracle_connection(sf).execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names) and type_differences(df, result) == []
    assert rows and digest(df.columns, rows) == digest(names, result.fetchall())
