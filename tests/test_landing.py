"""The landing of the test input: rows are dealt flat, once."""

import io
from contextlib import redirect_stdout
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from blockledger.plans.sink import session_settings
from blockledger.sources import ledger


def flat_tables(spark, path):
    """40 orders (one key twice, one null, one order without items), their items, 30 events (one without an id)."""
    keys = [*range(0, 80, 2), 4, None]
    spark.createDataFrame([(k, 7, "F", Decimal("10.50"), "1-URGENT") for k in keys],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice decimal(12,2), "
                          "o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    items = [(k, n, 10 + n, 3, Decimal(n), Decimal("5.00"), Decimal("0.10"), "NR"[n % 2], "O", Decimal("0.01"), date(2020, 1, n + 1))
             for k in [*range(2, 80, 2), 1001, None] for n in range(3)]
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity decimal(12,2), "
                          "l_extendedprice decimal(12,2), l_discount decimal(12,2), l_returnflag string, l_linestatus string, "
                          "l_tax decimal(12,2), l_shipdate date").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(None if i == 29 else i, i, "view", 1.5, "{}") for i in range(30)],
                          "event_id long, user_id long, event_type string, value double, props string").write.parquet(
        f"{path}/events.parquet")


@pytest.fixture()
def sf(spark, tmp_dir):
    flat_tables(spark, f"{tmp_dir}/sf")
    return f"{tmp_dir}/sf"


def test_only_flat_rows_are_shuffled_and_once(spark, sf):
    text = io.StringIO()
    with session_settings(spark, {"spark.sql.execution.useObjectHashAggregateExec": "false"}), redirect_stdout(text):
        ledger.nest_ledger(spark, sf, ledger.last_slot(spark, sf), 4).explain()
    plan = text.getvalue()
    assert plan.count("Exchange") == 1 and "ObjectHashAggregate" not in plan
    assert plan.count("Sort [") == 1


def test_nested_rows_of_odd_keys(spark, sf):
    rows = ledger.ledger_raw(spark, sf).collect()
    with_slot = {r["slot"]: r for r in rows if r["slot"] is not None}
    assert len(with_slot) == len([r for r in rows if r["slot"] is not None])
    n = {s: len(r["transactions"] or ()) for s, r in with_slot.items()}
    assert n == {0: 9, 1: 8, 2: 8, 3: 8, 4: 8}
    first = with_slot[0]["transactions"]
    assert [len(t["meta"]["rewards"]) for t in first] == [0] + [3] * 8      # both copies of an order get its items
    assert [len(with_slot[s]["rewards"] or ()) for s in range(5)] == [12, 12, 5, 0, 0]
    # Rows without a slot: the order's block and the event's are not one block.
    apart = [(len(r["transactions"] or ()), len(r["rewards"] or ())) for r in rows if r["slot"] is None]
    assert sorted(apart) == [(0, 1), (1, 0)]


@pytest.mark.parametrize("land", [ledger.land_json, ledger.land_broken, ledger.land_bad_items])
def test_json_is_landed_compressed(spark, sf, land):
    import glob
    out = land(spark, sf).removeprefix("file:")
    assert glob.glob(f"{out}/part-*") and all(f.endswith(".txt.gz") for f in glob.glob(f"{out}/part-*"))
    assert spark.read.text(out).count() == ledger.ledger_raw(spark, sf).count()


def test_json_files_hold_few_slots(spark, sf, monkeypatch):
    """One task writes many blocks, but a compressed file, which one task reads, holds few of them."""
    monkeypatch.setattr(ledger, "SLOTS_PER_FILE", 2)
    path = ledger.land_json(spark, sf)
    lines = [r["n"] for r in spark.read.text(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert max(lines) <= 2 and sum(lines) == ledger.ledger_raw(spark, sf).count()


def test_faults_are_landed_apart(spark, tmp_dir):
    """The rows of ``with_faults``, of which only those that it changes are landed again."""
    orders = spark.range(0, 1200).selectExpr("id as o_orderkey", "7L as o_custkey", "'F' as o_orderstatus",
                                             "10.5D as o_totalprice", "'1' as o_orderpriority")
    flat_tables(spark, f"{tmp_dir}/many")
    orders.write.mode("overwrite").parquet(f"{tmp_dir}/many/orders.parquet")
    sf = f"{tmp_dir}/many"
    whole = ledger.with_faults(ledger.ledger_raw(spark, sf))
    got = ledger.faulty_raw(spark, sf)
    key = F.xxhash64(*whole.columns).alias("h")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in whole.select(key).collect())
    again = spark.read.parquet(ledger._LANDED[spark.sparkContext.applicationId, sf, "faults"])
    assert 0 < again.count() < got.count() / 5
