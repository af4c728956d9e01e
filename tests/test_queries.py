"""Every registered query of the library against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from isohyet import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4)
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in catalog.SQL:
        want = duck.execute(catalog.SQL[name])
        assert got == rows([c[0] for c in want.description], want.fetchall())
    else:
        assert got[1]
