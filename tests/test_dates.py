"""Dates over batches: however the blocks are cut into batches, stores by date end up the same."""

from __future__ import annotations

import random

import pytest

from blockledger import schemas as S
from blockledger.plans import sink as K
from blockledger.session import fresh_namespace
from ledger_blocks import block, tx

DAY = 86400


def filled(times: dict[int, int | None]) -> dict[int, int | None]:
    """Day of each slot by the rule of R1, slot by slot."""
    known = sorted(s for s, t in times.items() if t is not None)
    out = {}
    for s, t in times.items():
        p, n = max((k for k in known if k < s), default=None), min((k for k in known if k > s), default=None)
        if t is None and p is not None and n is not None:
            t = times[p] + (times[n] - times[p]) * (s - p) // (n - p)
        elif t is None:
            e = p if p is not None else n
            t = times[e] if e is not None else None
        out[s] = None if t is None else t // DAY
    return out


def stored(spark, store):
    return {t: sorted((r.slot, None if r.d is None else r.d.toordinal() - 719163) for r in
                      K.read_table(spark, store, t).selectExpr("slot", f"{S.DATE_COLUMN} as d").collect())
            for t in store.tables}


def new_store(spark):
    return K.LedgerStore(namespace=fresh_namespace(spark, "days"), tables=("blocks", "transactions"), bucket_size=4, by_date=True)


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_store_the_dates_of_one_fill(spark, read_json, seed):
    r = random.Random(seed)
    times = {s: None if r.random() < 0.5 else s * DAY // 2 for s in r.sample(range(40), 24)}
    order = list(times)
    r.shuffle(order)
    store, there = new_store(spark), {}
    for lo in range(0, len(order), 6):
        part = order[lo:lo + 6]
        there |= {s: times[s] for s in part}
        K.write_all(read_json([block(s, [tx(f"s{s}")], block_time=times[s]) for s in part]), store)
        want = sorted(filled(there).items())
        assert stored(spark, store) == {"blocks": want, "transactions": want}


def test_move_that_ended_half_way_is_done_by_the_replay(spark, read_json, monkeypatch):
    store = new_store(spark)
    K.write_all(read_json([block(s, [tx(f"s{s}")], block_time=None) for s in (5, 6)]), store)
    assert stored(spark, store)["blocks"] == [(5, None), (6, None)]
    later = read_json([block(4, [tx("s4")], block_time=3 * DAY), block(9, [tx("s9")], block_time=3 * DAY)])
    replace = K.replace_buckets
    with monkeypatch.context() as m:
        def stop(spark, stage, store, table, buckets):
            if table == "blocks":
                raise RuntimeError("stopped")
            replace(spark, stage, store, table, buckets)
        m.setattr(K, "replace_buckets", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            K.write_all(later, store)
    K.write_all(later, store)
    want = [(s, 3) for s in (4, 5, 6, 9)]
    assert stored(spark, store) == {"blocks": want, "transactions": want}
