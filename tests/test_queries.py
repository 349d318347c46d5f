"""Every registered query with SQL gives what DuckDB gives for that SQL on the same tables."""

import duckdb
import pytest

from catalens.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    return v


def rows(cols, names, data):
    at = [names.index(c) for c in cols]
    return sorted((tuple(plain(r[i]) for i in at) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert sorted(want.columns) == cols
    assert rows(cols, df.columns, [tuple(r) for r in df.collect()]) == rows(cols, want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_run(spark, name):
    assert registry.queries()[name](spark, DATA).count() > 0
