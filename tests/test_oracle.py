"""Every query that has SQL gives the same rows in DuckDB."""

import os

import duckdb
import pytest

from almanac.plans import catalog

SF = "/root/testdata/sf0.001"


def rows(values, columns):
    def plain(v):
        if isinstance(v, float):
            v = round(v, 6)
        return (v is None, v.isoformat() if hasattr(v, "isoformat") else str(v))

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in values)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    got = rows([tuple(r) for r in df.collect()], df.columns)
    want = db.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert got == rows(want.fetchall(), columns)


def test_every_name_has_a_query():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
