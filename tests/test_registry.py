"""Every registered query against its DuckDB oracle on sf0.001 (the driver
does the same at sf0.01), plus contract checks on the registry."""

import hashlib
import math

import pytest

import __spark_entry__ as E
from zonecast.plans.oracle import all_oracle_sql
from zonecast.plans.registry import all_queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
ROWS_ONLY: set[str] = set()


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v).lower()
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


# the library's own queries; the text queries are tested in tests/llm
QUERIES, ORACLE = all_queries(), all_oracle_sql()


def test_every_query_has_an_oracle_or_is_rows_only():
    qs, sql = QUERIES, ORACLE
    assert set(qs) <= set(E.queries()) and set(sql) <= set(E.oracle_sql())
    assert set(sql) <= set(qs)
    assert set(qs) - set(sql) == ROWS_ONLY


@pytest.fixture(scope="module")
def duck(sf_small):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert len(srows) == len(orows)
    assert sorted(df.columns) == sorted(ocols)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "pu_hourly" in df.columns
