"""Every query with an oracle against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from gridcheck import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    clean = lambda v: round(v, 6) if isinstance(v, float) else v
    return [names[k] for k in order], sorted((tuple(str(clean(r[k])) for k in order) for r in data))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    found = rows(df.columns, df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql:
        got = duck.execute(sql)
        assert found == rows([c[0] for c in got.description], got.fetchall())
