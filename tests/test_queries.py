"""Every query of the record engine against its SQL on the small tables."""

import duckdb
import pytest

from glyphmill.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(str)
    return sorted(map(tuple, df.to_numpy().tolist()))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name in registry.ORACLE:
        want = duck.sql(registry.ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got) > 0


def test_oracles_belong_to_queries():
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    assert registry.FLAGSHIP in registry.QUERIES
