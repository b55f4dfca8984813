"""One publish for all tables: readers see a batch whole or not at all, whatever step a run ends at."""

from __future__ import annotations

from dataclasses import replace

import pytest

from blockledger.plans import backfill as M
from blockledger.plans import publish as U
from blockledger.plans import sink as K
from blockledger.session import fresh_namespace
from blockledger.streaming import ingest as ST
from ledger_blocks import block, tx, write_lines


class Stopped(Exception):
    pass


def stop(*_args, **_kw):
    raise Stopped


def blocks_of(slots):
    return [block(s, [tx(f"a{s}"), tx(f"b{s}")]) for s in slots]


@pytest.fixture()
def store(spark):
    return K.LedgerStore(namespace=fresh_namespace(spark, "pub"), bucket_size=4, one_publish=True)


def slots_seen(spark, store):
    return {t: sorted(r.slot for r in df.select("slot").collect()) for t, df in U.published(spark, store).items()}


def whole(slots):
    """What readers see when exactly these slots are published."""
    s = sorted(slots)
    return {"blocks": s, "transactions": sorted(s * 2), "instructions": sorted(s * 4), "rewards": s}


def open_lists(spark, store):
    return spark.table(store.fqn(U.IN_FLIGHT)).count()


def test_run_that_ends_between_tables_shows_nothing_and_is_resumed(spark, store, read_json):
    raw = read_json(blocks_of([1, 2, 3, 5, 64, 127, 128, 200]))
    M.write(raw.where("slot <= 3"), store)
    assert slots_seen(spark, store) == whole([1, 2, 3])
    U.begin(raw.where("slot >= 2"), store)
    K.write_all(raw.where("slot >= 2"), replace(store, tables=("blocks", "transactions")))
    assert slots_seen(spark, store) == whole([1, 2, 3])
    # Even with all four tables written, the run goes on below what is not published.
    K.write_all(raw, store)
    assert K.stored_last_processed(spark, store).first()[0] == 200
    assert U.last_published(spark, store).first()[0] == 4
    assert M.resume(spark, raw, store) == 5
    assert slots_seen(spark, store) == whole([1, 2, 3, 5, 64, 127, 128, 200])
    assert not open_lists(spark, store)
    assert U.last_published(spark, store).first()[0] == 200


def test_slot_torn_inside_a_table_is_rebuilt_before_it_is_published(spark, store, read_json):
    M.write(read_json(blocks_of([1, 9])), store)
    raw = read_json(blocks_of([2, 3]))
    U.begin(raw, store)
    from blockledger.operators import flatten as P
    K._insert(P.transactions(raw).where("signature like 'a%'"), store, "transactions", K.read_table(spark, store, "transactions"))
    assert slots_seen(spark, store) == whole([1, 9])
    M.write(raw, store)
    assert slots_seen(spark, store) == whole([1, 2, 3, 9])


def test_later_batch_takes_over_only_the_slots_it_brings(spark, store, read_json):
    raw = read_json(blocks_of(range(60, 70)))
    U.begin(raw, store)
    K.write_all(raw, replace(store, tables=("blocks",)))
    M.write(read_json(blocks_of([63, 64, 70])), store)
    assert slots_seen(spark, store) == whole([63, 64, 70])
    M.write(raw, store)
    assert slots_seen(spark, store) == whole(range(60, 71))
    assert not open_lists(spark, store)


@pytest.mark.parametrize("step", ["write", "repair", "rest", "old_list", "own_list"])
def test_end_at_each_step(spark, store, read_json, monkeypatch, step):
    M.write(read_json(blocks_of([1])), store)
    first, both = read_json(blocks_of([2, 3, 4])), read_json(blocks_of([3, 4, 5]))
    U.begin(first, store)
    K.write_all(first, replace(store, tables=("blocks", "rewards")))
    with monkeypatch.context() as m:
        if step == "write":
            m.setattr(K, "write_all", stop)
        elif step == "repair":
            m.setattr(M, "repair_missing", stop)
        elif step == "rest":
            add, calls = U._add, []
            m.setattr(U, "_add", lambda *a: stop() if calls else (calls.append(1), add(*a)))
        else:
            drop, calls = U._drop, []
            m.setattr(U, "_drop", lambda *a: stop() if step == "old_list" or calls else (calls.append(1), drop(*a)))
        with pytest.raises(Stopped):
            M.write(both, store)
    assert slots_seen(spark, store) == whole([1])
    M.write(both, store)
    assert slots_seen(spark, store) == whole([1, 3, 4, 5])
    M.write(first, store)
    assert slots_seen(spark, store) == whole(range(1, 6)) and not open_lists(spark, store)


def test_views_follow_the_lists(spark, store, read_json):
    raw = read_json(blocks_of([1, 2, 130]))
    M.write(raw.where("slot = 1"), store)
    names = U.create_views(spark, store)
    batch, over = U.begin(raw, store)
    K.write_all(raw, store)
    assert not over
    assert [sorted({r.slot for r in spark.table(n).collect()}) for n in names] == [[1]] * 4
    U.commit(spark, store, batch)
    assert [sorted({r.slot for r in spark.table(n).collect()}) for n in names] == [[1, 2, 130]] * 4


def test_empty_batch_and_rows_without_a_slot(spark, store, read_json):
    raw = read_json(blocks_of([1]) + [{**block(2), "slot": None}])
    M.write(raw.where("slot > 5"), store)
    assert slots_seen(spark, store) == whole([])
    M.write(raw, store)
    assert slots_seen(spark, store) == whole([1]) and not open_lists(spark, store)


def test_stream_replays_a_batch_that_was_not_published(spark, store, tmp_dir, monkeypatch):
    landing, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/ckpt"
    write_lines(landing, blocks_of([1, 2, 3]))

    def drain():
        ST.continuous_ingest(spark, landing, store, ckpt, available_now=True, hold_tip=False).awaitTermination()

    with monkeypatch.context() as m:
        m.setattr(U, "commit", stop)
        with pytest.raises(Exception):
            drain()
    assert slots_seen(spark, store) == whole([])
    drain()
    assert slots_seen(spark, store) == whole([1, 2, 3]) and not open_lists(spark, store)
