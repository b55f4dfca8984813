"""Registered queries vs their DuckDB oracle on the driver tables (sf0.001)."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from blockledger.registry import QUERIES
from ledger_blocks import SMALL

KEYS = sorted(QUERIES)


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted(
        repr(tuple(_norm(r[i]) for i in order)) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t)}.parquet')")
    return con


def test_every_query_has_an_oracle():
    qs, ors = E.queries(), E.oracle_sql()
    assert set(QUERIES) <= set(qs) and set(ors) <= set(qs)
    assert set(QUERIES) <= set(ors)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10 and [r.slot for r in rows] == sorted(r.slot for r in rows)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
