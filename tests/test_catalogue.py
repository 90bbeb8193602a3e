"""Each catalogue query against its SQL in DuckDB on the small tables."""

import duckdb
import pytest

from jobsieve.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "events", "orders", "part")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def _rows(frame):
    names = sorted(frame.columns)
    return sorted((tuple(None if x != x else str(x).removesuffix(" 00:00:00").removesuffix(".0") for x in r) for r in frame[names].astype(object).where(frame[names].notna(), None).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, FOLDER).toPandas()
    want = duck.sql(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
    assert len(got)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)
