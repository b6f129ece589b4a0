"""Every registered query of the engine's own operators against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from vellum.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set TimeZone='UTC'")
    for f in os.listdir(SF):
        c.sql(f"create view {f[:-8]} as from '{SF}/{f}'")
    return c


def shown(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple("~" if r[i] is None else repr(float(r[i])) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rel = duck.sql(SQL[name])
    assert shown(df.columns, [tuple(r) for r in df.collect()]) == shown(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
