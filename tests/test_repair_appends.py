"""Repairs and date moves rewrite no more than the rows they are about."""

from __future__ import annotations

from blockledger.plans import backfill as M
from blockledger.plans import sink as K
from blockledger.session import fresh_namespace
from ledger_blocks import block, tx

DAY = 86400


def counts(spark, store):
    return {t: K.read_table(spark, store, t).groupBy("slot").count().orderBy("slot").collect() for t in store.tables}


def test_slots_that_are_not_stored_are_appended(spark, read_json, monkeypatch):
    raw = read_json([block(s, [tx(f"a{s}"), tx(f"b{s}")]) for s in range(12)])
    store, whole = (K.LedgerStore(namespace=fresh_namespace(spark, "repair"), bucket_size=4) for _ in range(2))
    K.write_all(raw, whole)
    M.bounded_backfill(raw, store, 0, 5)
    rebuilt = []
    monkeypatch.setattr(K, "replace_buckets", lambda *a: rebuilt.append(a))
    assert M.repair_missing(spark, raw, store).count() == 6 * len(store.tables)
    assert not rebuilt
    assert counts(spark, store) == counts(spark, whole)
    assert M.repair_missing(spark, raw, store).count() == 0


def test_dates_move_before_the_batch_is_in(spark, read_json, monkeypatch):
    store = K.LedgerStore(namespace=fresh_namespace(spark, "days"), tables=("blocks", "transactions"), bucket_size=8, by_date=True)
    K.write_all(read_json([block(s, [tx(f"s{s}")], block_time=None) for s in (2, 3)]), store)
    replace, moved = K.replace_buckets, {}

    def seen(spark, stage, store, table, buckets):
        moved[table] = spark.read.parquet(stage).count()
        replace(spark, stage, store, table, buckets)
    monkeypatch.setattr(K, "replace_buckets", seen)
    K.write_all(read_json([block(s, [tx(f"s{s}")], block_time=3 * DAY) for s in (0, 1, 4, 5, 6)]), store)
    assert moved == {"blocks": 2, "transactions": 2}
    for t in store.tables:
        assert [(r.slot, str(r.block_date)) for r in K.read_table(spark, store, t).orderBy("slot").collect()] == [
            (s, "1970-01-04") for s in range(7)]
