"""Every query against its SQL twin."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    cols = sorted(df.columns)
    rel = duck.execute(oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = [tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()]
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    assert plain(got) == plain(want)


def test_entry(spark):
    assert entry(spark).count() > 0
