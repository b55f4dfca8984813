"""A1/A2 (H20), M1, M5 (H17), F2 (H21), R5 on hand-made blocks."""

from __future__ import annotations

import pytest

from blockledger.operators import flatten as P
from blockledger.operators import progress as G
from ledger_blocks import block, tx


def test_last_processed_cases_h20(spark, read_json):
    raw = read_json([block(s, [tx(f"s{s}")], rewards=[] if s > 3 else None) for s in range(1, 7)])
    t = P.flatten(raw)
    lp = lambda tables: G.last_processed_slot(spark, tables).first()[0]
    assert lp({"blocks": t["blocks"], "transactions": t["transactions"]}) == 6
    # a table that lags pulls the answer back
    assert lp({"blocks": t["blocks"], "transactions": t["transactions"].where("slot <= 4")}) == 4
    # empty table -> NULL; missing table -> NULL; nothing enabled -> NULL
    assert lp({"blocks": t["blocks"], "rewards": t["rewards"]}) is None
    assert lp({"blocks": t["blocks"], "transactions": None}) is None
    assert lp({}) is None


def test_start_position_modes(spark, read_json):
    raw = read_json([block(s) for s in (3, 4, 9)])
    tip = G.chain_tip(raw)
    lp = G.last_processed_slot(spark, {"blocks": P.blocks(raw).where("slot < 5")})
    got = {m: G.start_position(m, tip, lp).first()["start_slot"]
           for m in ("genesis", "latest", "last_processed", 7)}
    assert got == {"genesis": 0, "latest": 9, "last_processed": 5, 7: 7}
    none = G.last_processed_slot(spark, {"blocks": None})
    assert G.start_position("LAST_PROCESSED", tip, none).first()["start_slot"] == 0
    with pytest.raises(ValueError):
        G.parse_start("tomorrow")
    with pytest.raises(ValueError):
        G.parse_start(-1)


def test_skipped_slots_h17(read_json):
    raw = read_json([block(s) for s in (10, 11, 14, 16)])
    assert sorted(r.slot for r in G.skipped_slots(P.blocks(raw)).collect()) == [12, 13, 15]
    assert sorted(r.slot for r in G.skipped_slots(P.blocks(raw), 8, 12).collect()) == [8, 9, 12]


def test_slot_range_tip_not_processed_h21(read_json):
    raw = read_json([block(s) for s in range(20, 26)])
    f = G.slot_range_filter(21, None, 25)
    assert sorted(r.slot for r in raw.where(f).collect()) == [21, 22, 23, 24]
    f = G.slot_range_filter(21, 22, 25)
    assert sorted(r.slot for r in raw.where(f).collect()) == [21, 22]


def test_expected_rows_and_missing_by_table(read_json):
    meta = {"err": None, "fee": 1, "inner_instructions": [{"index": 0, "instructions": [
        {"program_id_index": 0, "accounts": [], "data": "z"}]}]}
    raw = read_json([block(1, [tx("a"), tx("b", meta=meta)]), block(2, [], rewards=None)])
    exp = {r.slot: r for r in G.expected_rows(raw).collect()}
    assert (exp[1].transactions, exp[1].instructions, exp[1].rewards) == (2, 5, 1)
    assert (exp[2].transactions, exp[2].instructions, exp[2].rewards) == (0, 0, 0)
    t = P.flatten(raw)
    stored = {"transactions": t["transactions"].where("signature = 'a'"), "rewards": t["rewards"]}
    miss = [(r.table_name, r.slot, r.expected_rows, r.stored_rows)
            for r in G.missing_by_table(raw, stored).collect()]
    assert miss == [("transactions", 1, 2, 1)]
