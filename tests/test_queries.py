"""Every query with SQL gives DuckDB's rows; every other one runs."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb
import pytest

from veinstone.plans import registry

SF = "/root/testdata/sf0.001"
#: Queries whose filters leave no rows of tables this small; their SQL must agree all the same.
NONE_HERE = {"anti_filter"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return str(v) if isinstance(v, bool) or not isinstance(v, (int, float, Decimal)) else repr(float(v))


def as_rows(table):
    names = sorted(table.column_names)
    return names, sorted(tuple(plain(x) for x in r) for r in zip(*[table.column(n).to_pylist() for n in names]))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    out = registry.queries()[name](spark, SF).toArrow()
    sql = registry.oracle_sql().get(name)
    assert out.num_rows > 0 or name in NONE_HERE
    if sql:
        assert as_rows(out) == as_rows(duck.sql(sql).to_arrow_table())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
