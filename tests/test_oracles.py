"""Every registered station query against its SQL in DuckDB, on the driver's tables."""

import decimal
import math
from pathlib import Path

import duckdb
import pytest

from stationflow import plans

DATA = Path("/root/testdata/sf0.001")
SQL = plans.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no driver tables")


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if v is None or isinstance(v, float) and math.isnan(v):
        return (0, "")
    if isinstance(v, bool) or isinstance(v, str):
        return (2, str(v))
    if isinstance(v, (int, float)):
        return (1, f"{float(v):.9g}" if v else "0")
    return (3, str(v))


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = plans.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    relation = duck.sql(SQL[name])
    at = {c: i for i, c in enumerate(relation.columns)}
    assert sorted(at) == columns
    assert got == sorted(tuple(plain(r[at[c]]) for c in columns) for r in relation.fetchall())


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert plans.queries()[name](spark, str(DATA)).count() >= 0
