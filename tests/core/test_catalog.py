import glob
import os

import duckdb
import pytest
from tidemark import catalog

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.sql(catalog.ORACLES[name])
    assert sorted(found.columns) == columns
    key = lambda row: tuple((x is None, str(x)) for x in row)
    mine = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    theirs = sorted((tuple(dict(zip(found.columns, r, strict=True))[c] for c in columns) for r in found.fetchall()), key=key)
    assert mine == theirs


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_flagship(spark, sf_dir):
    assert catalog.flagship(spark, sf_dir).count() > 10
