"""Every registered query of the general operators against its SQL."""

import math

import duckdb
import pytest

from scholium.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, bool):
        return str(value)
    return f"{float(value):.6f}" if isinstance(value, (int, float)) or type(value).__name__ == "Decimal" else str(value)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, con, name):
    found = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in found.fetchall())
    df = registry.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    got = sorted(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect())
    assert got == want


def test_queries_without_sql_run(spark):
    for name in set(registry.queries()) - set(registry.oracle_sql()):
        assert registry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
