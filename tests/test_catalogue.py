"""Every core query against its SQL in a second engine."""

import os

import duckdb
import pytest

from webloom.plans import catalogue


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for name in os.listdir(data):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{data}/{name}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, data, name):
    df = catalogue.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(repr(plain(tuple(r))) for r in df.select(*columns).collect())
    if name not in catalogue.ORACLE:
        assert got
        return
    result = duck.execute(catalogue.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(repr(plain(tuple(r[i] for i in order))) for r in result.fetchall())
