"""Registered queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from quayside import catalog, catalog_flows, catalog_plans, catalog_sources, catalog_writes  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        return round(x, 6) if isinstance(x, float) else x

    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr), sorted(columns)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, sf_dir)
    want = con.sql(catalog.ORACLE_SQL[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
