"""Every query with a SQL twin gives what DuckDB gives on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return db


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)
    relation = duck.sql(ORACLE[name])
    at = {c: i for i, c in enumerate(relation.columns)}
    assert sorted(at) == names
    assert got == sorted((tuple(r[at[c]] for c in names) for r in relation.fetchall()), key=str)
