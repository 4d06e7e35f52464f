"""Registered queries against their SQL in DuckDB on the smallest driver tables."""

import os

import pytest

import __spark_entry__
from tactus import plans

DIR = "/root/testdata/sf0.001"


def test_entry_names():
    assert set(plans.ORACLE_SQL) <= set(plans.QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir(DIR), reason="driver tables are missing")
@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    for f in os.listdir(DIR):
        db.sql(f"create view {f.split('.')[0]} as select * from '{DIR}/{f}'")
    df, want = plans.QUERIES[name](spark, DIR), db.sql(plans.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    tidy = lambda rows, names: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (r[names.index(c)] for c in columns)) for r in rows), key=repr)
    assert tidy([tuple(r) for r in df.collect()], df.columns) == tidy(want.fetchall(), want.columns)
