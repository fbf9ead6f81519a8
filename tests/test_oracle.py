"""Every query of the library against its SQL over the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from pelagia.plans.registry import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def sql():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLE:
        assert df.columns and rows
        return
    want = sql.sql(ORACLE[name])
    assert sorted(want.columns) == sorted(df.columns)
    names = sorted(df.columns)
    at = [want.columns.index(n) for n in names]
    a = sorted(tuple(plain(r[n]) for n in names) for r in rows)
    b = sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
    assert a == b
