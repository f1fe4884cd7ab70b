"""Every query with SQL agrees with DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from voxmill.plans import catalogue

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


def rows(df):
    def plain(v):
        v = v.item() if hasattr(v, "item") else v
        if v is None or str(v) == "<NA>" or v != v:
            return None
        return round(v, 6) if isinstance(v, float) else v

    df = df[sorted(df.columns)]
    return list(df.columns), sorted(([plain(v) for v in r] for r in df.itertuples(index=False)), key=str)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    columns, ours = rows(QUERIES[name](spark, DATA).toPandas())
    names, theirs = rows(duck.sql(SQL[name]).df())
    assert columns == names
    assert str(ours) == str(theirs)
