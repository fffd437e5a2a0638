"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from tamis.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return c


def plain(value):
    return round(float(value), 6) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(map(plain, (t[k] for k in order))) for t in tuples)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_its_sql(spark, con, name):
    df = registry.QUERIES[name](spark, DATA)
    cursor = con.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cursor.fetchall())
