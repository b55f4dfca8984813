"""Flatten operators on hand-made blocks (FIXTURES.md section 2, H1-H16)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from blockledger.functions import compat
from blockledger.operators import flatten as P
from ledger_blocks import block, ins, reward, token, tx


def rows(df, order=("slot",)):
    return [r.asDict(recursive=True) for r in df.orderBy(*order).collect()]


def test_plain_block_h1(read_json):
    raw = read_json([block(10, [tx("s1")])])
    assert P.blocks(raw).count() == 1
    t = rows(P.transactions(raw))
    assert len(t) == 1 and t[0]["signature"] == "s1" and t[0]["success"] is True
    assert t[0]["fee"] == 5000 and t[0]["pre_balances"] == [10, 20]
    assert t[0]["log_messages"] == ["log a", "log b"] and t[0]["compute_units_consumed"] == 150
    i = rows(P.instructions(raw), ("instruction_index",))
    assert [(r["instruction_index"], r["program_id"], r["accounts"], r["is_inner"], r["parent_index"])
            for r in i] == [(0, "k1", ["k0", "k2"], False, None), (1, "k2", ["k1"], False, None)]


def test_missing_block_time_kept_h2(read_json):
    raw = read_json([block(11, block_time=None)])
    r = rows(P.blocks(raw))
    assert r[0]["block_time"] is None and r[0]["slot"] == 11


def test_no_meta_h5(read_json):
    raw = read_json([block(12, [tx("s", meta=None)])])
    t = rows(P.transactions(raw))[0]
    for c in ("success", "error", "fee", "pre_balances", "post_balances", "pre_token_balances",
              "log_messages", "rewards", "compute_units_consumed"):
        assert t[c] is None, c
    assert P.instructions(raw).count() == 2       # top-level kept
    txt = rows(compat.transactions_as_text(P.transactions(raw)))[0]
    assert txt["pre_token_balances"] is None and txt["log_messages"] is None


def test_error_h6_and_header_h7(read_json):
    meta = {"err": "InstructionError", "fee": 1, "pre_balances": [], "post_balances": None}
    raw = read_json([block(13, [tx("s", meta=meta, header=None)])])
    t = rows(P.transactions(raw))[0]
    assert t["success"] is False and t["error"] == "InstructionError"
    assert t["num_required_signatures"] is None and t["num_readonly_unsigned_accounts"] is None
    assert t["pre_balances"] is None and t["post_balances"] is None   # H8: empty -> NULL


def test_token_balances_h9_h10(read_json):
    meta_empty = {"err": None, "fee": 1, "pre_token_balances": [], "post_token_balances": None}
    meta_tok = {"err": None, "fee": 1,
                "pre_token_balances": [token(0, "m0", owner=None, program_id=None), token(2, "m2")],
                "post_token_balances": [token(2, "m2", "9")]}
    raw = read_json([block(14, [tx("a", meta=meta_empty), tx("b", meta=meta_tok)])])
    t = {r["signature"]: r for r in rows(P.transactions(raw))}
    assert t["a"]["pre_token_balances"] is None and t["a"]["post_token_balances"] is None
    pre = t["b"]["pre_token_balances"]
    assert pre[0] == {"account_index": 0, "mint": "m0", "amount": "5", "decimals": 0,
                      "ui_amount": 5.0, "ui_amount_string": "5", "owner": None, "program_id": None}
    assert pre[1]["owner"] == "own"
    long = rows(P.token_balances(raw), ("signature", "side", "position"))
    assert [(r["side"], r["position"], r["mint"]) for r in long] == [
        ("post", 0, "m2"), ("pre", 0, "m0"), ("pre", 1, "m2")]
    txt = {r["signature"]: r for r in rows(compat.transactions_as_text(P.transactions(raw)))}
    assert txt["a"]["pre_token_balances"] == "null"
    assert json.loads(txt["b"]["pre_token_balances"])[0]["owner"] is None


def test_program_id_and_accounts_h11_h12(read_json):
    raw = read_json([block(15, [tx("s", keys=["k0", "k1"],
                                   instructions=[ins(5, [0, 7, 1, 9], "x")])])])
    r = rows(P.instructions(raw))[0]
    assert r["program_id_index"] == 5 and r["program_id"] is None
    assert r["accounts"] == ["k0", "k1"]
    acc = rows(P.resolved_accounts(raw), ("account_position",))
    assert [(a["account_position"], a["account"]) for a in acc] == [(0, "k0"), (1, "k1")]


def test_inner_groups_h13_h14(read_json):
    meta = {"err": None, "fee": 1, "inner_instructions": [
        {"index": 0, "instructions": [ins(0, [1]), ins(1, [2])]},
        {"index": 3, "instructions": [ins(2, [0])]}]}
    raw = read_json([block(16, [tx("s", meta=meta), tx("t", meta={"err": None, "fee": 1})])])
    inner = rows(P.instructions_inner(raw), ("parent_index", "instruction_index"))
    assert [(r["parent_index"], r["instruction_index"], r["program_id"]) for r in inner] == [
        (0, 0, "k0"), (0, 1, "k1"), (3, 0, "k2")]
    assert all(r["is_inner"] for r in inner)
    both = P.instructions(raw)
    assert both.count() == 2 + 2 + 3            # two txs x 2 top + 3 inner
    two = P.instructions(raw, one_pass=False)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, two.collect()))


def test_rewards_h15_h16(read_json):
    rw = [reward("a", -5, rtype=None, commission=None), reward("b", 7, rtype="voting", commission=10)]
    raw = read_json([block(17, rewards=rw), block(18, rewards=None), block(19, rewards=[])])
    r = rows(P.rewards(raw), ("pubkey",))
    assert [(x["slot"], x["pubkey"], x["lamports"], x["reward_type"], x["commission"]) for x in r] == [
        (17, "a", -5, None, None), (17, "b", 7, "voting", 10)]
    assert P.blocks(raw).count() == 3          # blocks without rewards are kept
    txt = rows(compat.rewards_as_text(P.rewards(raw)), ("pubkey",))
    assert txt[0]["reward_type"] == "None"


def test_tx_rewards_tagged_with_slot(read_json):
    raw = read_json([block(20, [tx("s")])])
    r = rows(P.tx_rewards(raw))
    assert r == [{"slot": 20, "signature": "s", "position": 0, "pubkey": "r1", "lamports": 3,
                  "post_balance": 100, "reward_type": "fee", "commission": None}]


def test_flatten_properties_on_ledger(spark):
    """Sum of sizes = rows; top + inner = all; flatten(A u B) = flatten A u flatten B."""
    from blockledger.sources import ledger
    raw = ledger.ledger_raw(spark, "/root/testdata/sf0.001")
    n_tx = raw.agg(F.sum(F.size("transactions"))).first()[0]
    assert P.transactions(raw).count() == n_tx
    top, inner = P.instructions_top(raw).count(), P.instructions_inner(raw).count()
    assert P.instructions(raw).count() == top + inner
    a, b = raw.where("slot % 2 = 0"), raw.where("slot % 2 = 1")
    whole = P.instructions(raw)
    parts = P.instructions(a).unionByName(P.instructions(b))
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_inner_group_without_instructions_keeps_other_groups(read_json):
    meta = {"err": None, "fee": 1, "inner_instructions": [
        {"index": 0, "instructions": None},
        {"index": 2, "instructions": [ins(1, [0])]}]}
    raw = read_json([block(21, [tx("s", meta=meta)])])
    for one_pass in (True, False):
        inner = P.instructions(raw, one_pass=one_pass).where("is_inner").collect()
        assert [(r.parent_index, r.instruction_index, r.program_id) for r in inner] == [(2, 0, "k1")]


def test_meta_without_error_fee_and_units_is_still_meta(read_json):
    raw = read_json([block(1, [tx("a", meta={"log_messages": ["x"]}), tx("b", meta={"pre_balances": [1]}), tx("c", meta=None)])])
    assert {r.signature: r.success for r in P.transactions(raw).collect()} == {"a": True, "b": True, "c": None}
