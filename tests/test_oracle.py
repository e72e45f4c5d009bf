"""Every registered query against its SQL counterpart, over the whole sf0.01 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as registry
from oracle import ORACLE_SQL
from tripflow.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if value is None:
            return "~"
        if isinstance(value, float):
            return "nan" if math.isnan(value) else f"{value:.6f}"
        return str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, oracle, name):
    frame = QUERIES[name](spark, SF_DIR)
    found = canonical(frame.columns, frame.collect())
    expected = oracle.execute(ORACLE_SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(frame.columns) == sorted(columns)
    assert found == canonical(columns, expected.fetchall())
    assert found


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= registry.queries().keys()
    assert registry.oracle_sql().keys() <= registry.queries().keys()


def test_entry(spark):
    assert registry.entry(spark).count() == 1000
