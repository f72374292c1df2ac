"""Every registered query runs on the smallest tables; where there is SQL, both give the same rows."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
#: Queries of the optional subpackage have tests of their own.
CORE = [n for m in entry._modules() if "llm" not in m.__name__ for n in m.QUERIES]


def norm(v):
    if isinstance(v, float):
        return ("f", round(v, 6))
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = Counter(repr([norm(r[c]) for c in cols]) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql:
        cur = con.execute(sql)
        names = [x[0] for x in cur.description]
        assert sorted(names) == cols
        want = Counter(repr([norm(r[names.index(c)]) for c in cols]) for r in cur.fetchall())
        assert got == want


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
