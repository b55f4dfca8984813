"""Declared schemas: the nested landed block (RAW_BLOCK) and the four flat tables.

Column order of the flat tables is contractual; nested-JSON columns of the
string schema are native nested types here (``functions.compat`` renders the
string form on demand).
"""

from __future__ import annotations

from pyspark.sql import types as T

L, S, B, D = T.LongType(), T.StringType(), T.BooleanType(), T.DoubleType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


INSTR = T.StructType([
    _f("program_id_index", L),
    _f("accounts", T.ArrayType(L)),
    _f("data", S),
])

TOKEN = T.StructType([
    _f("account_index", L),
    _f("mint", S),
    _f("ui_token_amount", T.StructType([
        _f("amount", S),
        _f("decimals", L),
        _f("ui_amount", D),
        _f("ui_amount_string", S),
    ])),
    _f("owner", S),
    _f("program_id", S),
])

REWARD = T.StructType([
    _f("pubkey", S),
    _f("lamports", L),
    _f("post_balance", L),
    _f("reward_type", S),
    _f("commission", L),
])

# Mark of a transaction whose own values could not be read: no row, but its instructions stay.
UNREADABLE = "unreadable"

TX = T.StructType([
    _f("transaction", T.StructType([
        _f("signatures", T.ArrayType(S)),
        _f("message", T.StructType([
            _f("header", T.StructType([
                _f("num_required_signatures", L),
                _f("num_readonly_signed_accounts", L),
                _f("num_readonly_unsigned_accounts", L),
            ])),
            _f("account_keys", T.ArrayType(S)),
            _f("recent_blockhash", S),
            _f("instructions", T.ArrayType(INSTR)),
        ])),
    ])),
    _f("meta", T.StructType([
        _f("err", S),
        _f("fee", L),
        _f("pre_balances", T.ArrayType(L)),
        _f("post_balances", T.ArrayType(L)),
        _f("pre_token_balances", T.ArrayType(TOKEN)),
        _f("post_token_balances", T.ArrayType(TOKEN)),
        _f("log_messages", T.ArrayType(S)),
        _f("rewards", T.ArrayType(REWARD)),
        _f("compute_units_consumed", L),
        _f("inner_instructions", T.ArrayType(T.StructType([
            _f("index", L),
            _f("instructions", T.ArrayType(INSTR)),
        ]))),
    ])),
    _f(UNREADABLE, B),
])

RAW_BLOCK = T.StructType([
    _f("slot", L),
    _f("parent_slot", L),
    _f("block_time", L),
    _f("block_height", L),
    _f("previous_blockhash", S),
    _f("blockhash", S),
    _f("rewards", T.ArrayType(REWARD)),
    _f("transactions", T.ArrayType(TX)),
])

CORRUPT_COLUMN = "_corrupt_record"

# Normalised token balance: the nested amount lifted to eight flat fields.
TOKEN_FLAT = T.StructType([
    _f("account_index", L),
    _f("mint", S),
    _f("amount", S),
    _f("decimals", L),
    _f("ui_amount", D),
    _f("ui_amount_string", S),
    _f("owner", S),
    _f("program_id", S),
])

TX_REWARD = T.StructType([_f("slot", L)] + list(REWARD.fields))

BLOCKS = T.StructType([
    _f("slot", L, False),
    _f("parent_slot", L, False),
    _f("block_time", L),
    _f("block_height", L, False),
    _f("previous_blockhash", S, False),
    _f("blockhash", S, False),
])

TRANSACTIONS = T.StructType([
    _f("slot", L, False),
    _f("signature", S, False),
    _f("num_required_signatures", L),
    _f("num_readonly_signed_accounts", L),
    _f("num_readonly_unsigned_accounts", L),
    _f("recent_blockhash", S),
    _f("success", B),
    _f("error", S),
    _f("fee", L),
    _f("pre_balances", T.ArrayType(L)),
    _f("post_balances", T.ArrayType(L)),
    _f("pre_token_balances", T.ArrayType(TOKEN_FLAT)),
    _f("post_token_balances", T.ArrayType(TOKEN_FLAT)),
    _f("log_messages", T.ArrayType(S)),
    _f("rewards", T.ArrayType(TX_REWARD)),
    _f("compute_units_consumed", L),
])

INSTRUCTIONS = T.StructType([
    _f("slot", L, False),
    _f("tx_signature", S, False),
    _f("instruction_index", L),
    _f("program_id_index", L),
    _f("program_id", S),
    _f("accounts", T.ArrayType(S)),
    _f("data", S),
    _f("is_inner", B),
    _f("parent_index", L),
])

REWARDS = T.StructType([
    _f("slot", L, False),
    _f("pubkey", S),
    _f("lamports", L),
    _f("post_balance", L),
    _f("reward_type", S),
    _f("commission", L),
])

# Table order is the write order of one slot (blocks first).
TABLES: dict[str, T.StructType] = {
    "blocks": BLOCKS,
    "transactions": TRANSACTIONS,
    "instructions": INSTRUCTIONS,
    "rewards": REWARDS,
}

TABLE_NAMES = tuple(TABLES)

# Columns of the all-string table schema that hold JSON text.
JSON_COLUMNS = {
    "transactions": ("pre_balances", "post_balances", "pre_token_balances",
                     "post_token_balances", "log_messages", "rewards"),
    "instructions": ("accounts",),
}


def required_columns(table: str) -> list[str]:
    """Columns declared NOT NULL for ``table``."""
    return [f.name for f in TABLES[table].fields if not f.nullable]


def partition_column() -> str:
    return "slot_bucket"


#: Column of tables that are also partitioned by date.
DATE_COLUMN = "block_date"


def carried(columns: list[str]) -> list[str]:
    """Columns that row tables take over from the block rows, where those have them."""
    return [c for c in (DATE_COLUMN,) if c in columns]
