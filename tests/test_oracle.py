"""Every driver query against its DuckDB twin on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from pitlane.plans.queries import ORACLE, QUERIES

DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.sql(ORACLE[name])
    want = canon(res.columns, res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
    # the same column types on both sides
    spark_types = {c: DUCK.get(t, t) for c, t in df.dtypes}
    duck_types = dict(zip(res.columns, (str(t) for t in res.types)))
    assert spark_types == duck_types


def test_entry_lists_every_query_and_its_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "chunk_id" in df.columns and "raceId" in df.columns
