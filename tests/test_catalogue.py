"""Every query with SQL against DuckDB on the small tables."""

import math
import os

import duckdb
import pytest

from quarryline.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def one(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else str(round(x, 5) + 0.0)
        if isinstance(x, int) and not isinstance(x, bool):
            return str(float(x))
        return str(x)

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_like_sql(spark, db, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = db.sql(catalogue.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.collect(), got.columns) == plain(want.limit(10**9).fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_without_sql(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "latest_per_content_key" in entry.queries()
