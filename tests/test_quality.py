"""E1 permissive read (H18), E2 rejects (H3, H4), R3 nullability, S8 conform."""

from __future__ import annotations

import json

from blockledger.operators import flatten as P
from blockledger.operators import progress as G
from blockledger.operators import quality as Q
from ledger_blocks import block, tx, write_lines


def test_corrupt_records_h18(spark, tmp_dir):
    good = block(30, [tx("s")])
    big = json.dumps(block(31)).replace('"block_height": 31', '"block_height": 99999999999999999999')
    path = write_lines(f"{tmp_dir}/landed", [good, "{not json", big, block(32)])
    ok, bad = Q.read_permissive(spark, path)
    assert sorted(r.slot for r in ok.collect()) == [30, 32]      # whole rows read
    good_df, bad_df = Q.convert_landed(spark, path, f"{tmp_dir}/converted", keep_partial=False)
    assert sorted(r.slot for r in good_df.select("slot").collect()) == [30, 32]
    assert bad_df.count() == 2
    assert P.transactions(good_df).count() == 1
    # default: the block with one unreadable value is kept, that value NULL
    kept, logged = Q.convert_landed(spark, path, f"{tmp_dir}/converted2")
    rows = {r.slot: r for r in kept.collect()}
    assert sorted(rows) == [30, 31, 32] and rows[31].block_height is None
    assert logged.count() == 2


def test_bad_item_dropped_rest_of_block_kept(spark, tmp_dir):
    line = json.dumps(block(7, [tx("good"), tx("bad"), tx("good2")]))
    i = line.index('"fee": 5000', line.index('"bad"'))
    line = line[:i] + '"fee": "abc"' + line[i + len('"fee": 5000'):]
    path = write_lines(f"{tmp_dir}/landed-bad-item", [line])
    kept, logged = Q.convert_landed(spark, path, f"{tmp_dir}/conv-bad-item")
    fees = {r.signature: r.fee for r in P.transactions(kept).collect()}
    assert fees == {"good": 5000, "good2": 5000}
    # The transaction's own fee is bad, not its instructions.
    assert {r.tx_signature for r in P.instructions(kept).collect()} == {"good", "bad", "good2"}
    assert {r.transactions for r in G.expected_rows(kept).collect()} == {2}
    assert logged.count() == 1


def test_items_dropped_one_by_one(spark, tmp_dir):
    """Bad instructions end their transaction's list; bad balances and rewards only leave a gap."""
    def ins(n, bad=False):
        return {"program_id_index": "x" if bad else 0, "accounts": [0], "data": f"d{n}"}

    def token(i):
        return {"account_index": i, "mint": "m", "ui_token_amount": {"amount": "1", "decimals": 0, "ui_amount": 1.5, "ui_amount_string": "1"}}

    def reward(key, lamports=1):
        return {"pubkey": key, "lamports": lamports, "post_balance": 2, "reward_type": "fee", "commission": None}

    def groups(*gs):
        return [{"index": i, "instructions": list(g)} for i, g in gs]

    def made(sig, top, inner=(), **meta):
        t = tx(sig, meta={"err": None, "fee": 7, "pre_balances": [1], "post_balances": [1], "inner_instructions": inner, **meta})
        t["transaction"]["message"]["instructions"] = top
        return t
    lines = [block(9, [
        made("whole", [ins(0)], groups((0, [ins(1)]))),
        made("top", [ins(0), ins(1, True), ins(2)], groups((0, [ins(3)]))),
        made("inner", [ins(0)], groups((0, [ins(1)]), (1, [ins(2), ins(3, True), ins(4)]), (2, [ins(5)]))),
        made("group", [ins(0)], groups((0, [ins(1)]), ("x", [ins(2)]), (2, [ins(3)]))),
        made("lists", [ins(0)], pre_token_balances=[token(0), token("y"), token(2)], rewards=[reward("a"), reward("b", "z"), reward("c")]),
        made("fee", [ins(0)], fee="q", pre_token_balances=[token(0)]),
        5, None,
    ], rewards=[reward("r0"), reward("r1", "many"), reward("r2")]), block(10, [made("other", [ins(0)])])]
    path = write_lines(f"{tmp_dir}/landed-items", lines)
    kept, logged = Q.convert_landed(spark, path, f"{tmp_dir}/conv-items")
    assert [r.slot for r in logged.collect()] == [9]
    kept = kept.where("slot = 9")
    assert [r.pubkey for r in P.rewards(kept).collect()] == ["r0", "r2"]
    txs = {r.signature: r for r in P.transactions(kept).collect()}
    assert set(txs) == {"whole", "top", "inner", "group", "lists", None}  # a null item stays a row without a signature
    assert [b.account_index for b in txs["lists"].pre_token_balances] == [0, 2]
    assert txs["lists"].pre_token_balances[0].ui_amount == 1.5
    assert [r.pubkey for r in txs["lists"].rewards] == ["a", "c"]
    got = {}
    for r in P.instructions(kept).orderBy("is_inner", "parent_index", "instruction_index").collect():
        got.setdefault(r.tx_signature, []).append(r.data)
    assert got == {"whole": ["d0", "d1"], "top": ["d0"], "inner": ["d0", "d1", "d2"], "group": ["d0", "d1"],
                   "lists": ["d0"], "fee": ["d0"]}
    expected = G.expected_rows(kept).first()
    assert (expected.transactions, expected.instructions, expected.rewards) == (5, 10, 2)


def test_rejects_h3_h4(read_json):
    raw = read_json([block(40, block_height=None),
                     block(41, [tx("good"), tx("bad", signatures=[])])])
    ok_b, bad_b = Q.split_rejected(P.blocks(raw), "blocks")
    assert [r.slot for r in bad_b.collect()] == [40]
    assert bad_b.first()["reject_reason"] == "block_height is null"
    assert [r.slot for r in ok_b.collect()] == [41]
    ok_t, bad_t = Q.split_rejected(P.transactions(raw), "transactions")
    assert [r.signature for r in ok_t.collect()] == ["good"]
    assert bad_t.count() == 1
    ok_i, bad_i = Q.split_rejected(P.instructions(raw), "instructions")
    assert ok_i.count() == 2 and bad_i.count() == 2       # siblings kept
    counts = {r.table_name: (r.accepted_rows, r.rejected_rows)
              for r in Q.reject_counts({"blocks": P.blocks(raw),
                                        "transactions": P.transactions(raw)}).collect()}
    assert counts == {"blocks": (1, 1), "transactions": (1, 1)}


def test_nullability_report(read_json):
    raw = read_json([block(50, block_time=None, block_height=None), block(51)])
    rep = {(r.table_name, r.column_name): r for r in
           Q.nullability_report({"blocks": P.blocks(raw)}).collect()}
    assert rep[("blocks", "block_time")].null_count == 1
    assert rep[("blocks", "block_time")].violations == 0        # declared nullable
    assert rep[("blocks", "block_height")].violations == 1       # declared NOT NULL
    assert rep[("blocks", "slot")].row_count == 2


def test_conform_casts_to_declared_schema(spark):
    df = spark.createDataFrame([(1, "p", 2, 3, "x", 4)],
                               "slot int, pubkey string, lamports int, post_balance int, "
                               "reward_type string, commission int")
    out = Q.conform(df, "rewards")
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "bigint", "string", "bigint", "bigint", "string", "bigint"]


def test_conversion_shuffles_no_row(spark, tmp_dir, monkeypatch):
    """Lines are parsed once, and blocks stay with the files they were landed in; sorted there."""
    path = write_lines(f"{tmp_dir}/lines", [block(s) for s in (5, 3, 9)])
    called = []
    moved = type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda *a: called.append(a) or moved(*a))
    good, rejected = Q.convert_landed(spark, path, f"{tmp_dir}/converted")
    assert not called and rejected.count() == 0
    assert [r["slot"] for r in good.select("slot").collect()] == [3, 5, 9]
