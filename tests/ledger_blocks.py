"""Hand-made blocks as JSON lines, for the ledger tests."""

from __future__ import annotations

import json
import os
import uuid

SMALL = "/root/testdata/sf0.001"


def ins(pid, accounts, data="d"):
    return {"program_id_index": pid, "accounts": accounts, "data": data}


def token(idx, mint, amount="5", owner="own", program_id="prog"):
    return {"account_index": idx, "mint": mint,
            "ui_token_amount": {"amount": amount, "decimals": 0, "ui_amount": float(amount),
                                "ui_amount_string": amount},
            "owner": owner, "program_id": program_id}


def reward(pubkey, lamports, post=100, rtype="fee", commission=None):
    return {"pubkey": pubkey, "lamports": lamports, "post_balance": post,
            "reward_type": rtype, "commission": commission}


DEFAULT = object()


def tx(sig="s", keys=("k0", "k1", "k2"), instructions=DEFAULT, header=DEFAULT, meta=DEFAULT,
       signatures=DEFAULT):
    if instructions is DEFAULT:
        instructions = [ins(1, [0, 2], "a"), ins(2, [1], "b")]
    if header is DEFAULT:
        header = {"num_required_signatures": 1, "num_readonly_signed_accounts": 0,
                  "num_readonly_unsigned_accounts": 1}
    if meta is DEFAULT:
        meta = {"err": None, "fee": 5000, "pre_balances": [10, 20], "post_balances": [5, 25],
                "pre_token_balances": [token(1, "m1")], "post_token_balances": [token(1, "m1", "7")],
                "log_messages": ["log a", "log b"], "rewards": [reward("r1", 3)],
                "compute_units_consumed": 150, "inner_instructions": None}
    message = {"account_keys": list(keys) if keys is not None else None,
               "recent_blockhash": "rb", "instructions": instructions}
    if header is not None:
        message["header"] = header
    return {"transaction": {"signatures": [sig] if signatures is DEFAULT else signatures,
                            "message": message},
            "meta": meta}


def block(slot, txs=(), rewards=DEFAULT, block_time=DEFAULT, block_height=DEFAULT, parent=None):
    b = {"slot": slot, "parent_slot": (slot or 0) - 1 if parent is None else parent,
         "block_time": 1000 + 2 * slot if block_time is DEFAULT else block_time,
         "block_height": slot if block_height is DEFAULT else block_height,
         "previous_blockhash": f"h{(slot or 0) - 1}", "blockhash": f"h{slot}",
         "rewards": [reward(f"v{slot}", 10)] if rewards is DEFAULT else rewards,
         "transactions": list(txs)}
    return b


def write_lines(path: str, lines) -> str:
    os.makedirs(path, exist_ok=True)
    name = os.path.join(path, f"part-{uuid.uuid4().hex[:8]}.json")
    with open(name, "w") as f:
        for line in lines:
            f.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    return path
