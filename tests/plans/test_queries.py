"""Every query that SQL can express, against that SQL, over the small tables."""

import glob
import os

import duckdb
import pytest

from tidings.plans import catalog_queries, flow_queries, page_queries, queries, reader_queries  # noqa: F401  they register their queries


@pytest.fixture(scope="module")
def sql(sf):
    with duckdb.connect() as c:
        for f in glob.glob(f"{sf}/*.parquet"):
            c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
        yield c


def plain(x):
    if isinstance(x, float):
        return round(x, 6)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf, sql, name):
    got = queries.QUERIES[name](spark, sf)
    found = sql.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str)
    assert rows == sorted((tuple(map(plain, r)) for r in found.fetchall()), key=str)
