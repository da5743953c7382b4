"""Every registered query against its SQL, over the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("GRANARY_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if hasattr(v, "replace") and hasattr(v, "tzinfo"):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(FOLDER):
        at = f"{FOLDER}/{f}"
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{at}/*.parquet'" if os.path.isdir(at) else f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{at}'")
    return con


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    cur = duck.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in df.columns)) for r in cur.fetchall())
    assert sorted(repr(tuple(plain(x) for x in r)) for r in rows) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_is_of_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
