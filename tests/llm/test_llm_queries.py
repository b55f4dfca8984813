"""Registered queries: one for each operator, and agreement with their SQL."""

import os
import re

import duckdb
import pytest

import __spark_entry__
from blockledger.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert len([k for k in names if re.match(rf"op{n}_", k)]) == 1
    assert "pipeline" in names
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        assert os.path.exists(f"{SF}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_over_the_whole_table(spark, name):
    got = QUERIES[name](spark, SF)
    if name.startswith("op3_"):
        assert got.count() > 0
    else:
        table = "pages" if name.startswith("op8_") else "documents"
        assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
