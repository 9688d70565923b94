"""Every registered query with an oracle against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from clinloom.plans import clinical, evaluation, fhir, governed, lookup, registry, storage  # noqa: F401

DATA = "/root/testdata/sf0.001"
TABLES = [f.removesuffix(".parquet") for f in sorted(os.listdir(DATA))] if os.path.isdir(DATA) else []

pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_oracle(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert table(df.columns, df.collect()) == table(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs_without_oracle(spark, name):
    assert registry.queries()[name](spark, DATA).count() >= 0
