"""Every core query with SQL against DuckDB on the smallest tables."""

import datetime as dt
import glob
import math
import os
from importlib import import_module

import duckdb
import pytest

import __spark_entry__ as entry

CORE = {n: m for m in map(import_module, entry.MODULES) for n in m.QUERIES}
CASES = [(n, m.SQL[n]) for n, m in CORE.items() if n in m.SQL]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{entry.SF_SMOKE}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f).split('.')[0]} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v


@pytest.mark.parametrize("name,sql", CASES, ids=[n for n, _ in CASES])
def test_query_equals_sql(spark, duck, name, sql):
    df = CORE[name].QUERIES[name](spark, entry.SF_SMOKE)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(v) for v in r)) for r in df.select(*columns).collect())
    cur = duck.execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in cur.fetchall())
    assert got == want
