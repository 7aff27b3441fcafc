"""Every registered query runs; those with SQL give the same rows as the SQL."""

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_entry(spark):
    assert entry.entry(spark).count() == 4


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    got = canon(df.collect(), df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == canon(cursor.fetchall(), names)
