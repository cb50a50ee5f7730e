import os

import duckdb
import pytest

import __spark_entry__
from vellum.plans import catalog

from .conftest import SF


def normal(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_equals_sql(spark, sql, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(repr([normal(r[c]) for c in columns]) for r in df.collect())
    got = sql.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    assert ours == sorted(repr([normal(r[names.index(c)]) for c in columns]) for r in got.fetchall())


def test_flagship_totals(spark):
    rows = __spark_entry__.entry(spark).collect()
    total = lambda c: sum(r[c] for r in rows)
    assert [total(c) for c in ("docs", "num_images", "num_tables", "num_headings", "captionable")] == [200, 117, 40, 250, 67]


def test_contract(spark):
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q)
    assert set(catalog.QUERIES) <= set(q)
