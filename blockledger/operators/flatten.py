"""Flatten landed blocks (RAW_BLOCK) into the four ledger tables.

All operators are narrow: ``explode`` / ``posexplode`` / ``inline`` over one
block row, so flattening never shuffles.  Each takes and returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import expressions as X


def blocks(raw: DataFrame) -> DataFrame:
    """One header row per block.

    This and the other tables take over ``S.DATE_COLUMN`` where ``raw`` has it.
    """
    return raw.select(*[F.col(f.name) for f in S.BLOCKS.fields], *S.carried(raw.columns))


def tx_rows(raw: DataFrame, readable: bool = True, **paths: str) -> DataFrame:
    """One row per transaction with only the named nested fields: (slot, name...).

    Each ``name=path`` extracts ``transactions.<path>`` as an array over the
    block's transactions; the arrays are zipped and exploded.  Parquet then
    reads just those leaves (nested schema pruning does not pass through an
    ``explode`` of the whole transaction struct).  Transactions whose own values
    could not be read are left out where ``readable``.
    """
    if readable:
        rows = tx_rows(raw, False, **paths, _unreadable=S.UNREADABLE)
        return rows.where(~F.coalesce(F.col("_unreadable"), F.lit(False))).drop("_unreadable")
    t = F.col("transactions")
    cols = []
    for name, path in paths.items():
        c = t
        for part in path.split("."):
            c = c[part]
        cols.append(c.alias(name))
    keep = S.carried(raw.columns)
    return (raw.select("slot", *keep, F.explode(F.arrays_zip(*cols)).alias("t"))
            .select("slot", *keep, *[F.col(f"t.{n}").alias(n) for n in paths]))


# Leaves that tell whether a transaction has meta: the fee is part of every meta.
META_FLAG = {"err": "meta.err", "fee": "meta.fee", "units": "meta.compute_units_consumed"}
# Where these are read anyway, they show that meta is there too.
META_LEAVES = META_FLAG | {"pre": "meta.pre_balances", "post": "meta.post_balances", "logs": "meta.log_messages"}


def transactions(raw: DataFrame) -> DataFrame:
    """P2 (with P3-P10): one row per transaction, 16 columns."""
    header = F.col("header")
    txs = tx_rows(raw, signatures="transaction.signatures", header="transaction.message.header",
                  recent_blockhash="transaction.message.recent_blockhash", **META_LEAVES,
                  pre_tokens="meta.pre_token_balances", post_tokens="meta.post_token_balances",
                  rewards="meta.rewards")
    return txs.select(
        F.col("slot"),
        X.first_or_null("signatures").alias("signature"),
        header["num_required_signatures"].alias("num_required_signatures"),
        header["num_readonly_signed_accounts"].alias("num_readonly_signed_accounts"),
        header["num_readonly_unsigned_accounts"].alias("num_readonly_unsigned_accounts"),
        F.col("recent_blockhash"),
        X.success_of(*META_LEAVES).alias("success"),
        X.error_of("err").alias("error"),
        F.col("fee"),
        X.non_empty_or_null("pre").alias("pre_balances"),
        X.non_empty_or_null("post").alias("post_balances"),
        X.normalise_token_balances("pre_tokens").alias("pre_token_balances"),
        X.normalise_token_balances("post_tokens").alias("post_token_balances"),
        F.col("logs").alias("log_messages"),
        X.tag_rewards("rewards", F.col("slot")).alias("rewards"),
        F.col("units").alias("compute_units_consumed"),
        *S.carried(raw.columns),
    )


def tx_status(raw: DataFrame) -> DataFrame:
    """P5: success / error per transaction (reads signatures and META_FLAG only)."""
    txs = tx_rows(raw, signatures="transaction.signatures", **META_FLAG)
    return txs.select("slot", X.first_or_null("signatures").alias("signature"),
                      X.success_of(*META_FLAG).alias("success"),
                      X.error_of("err").alias("error"))


def token_balances(raw: DataFrame) -> DataFrame:
    """P8 long form: one row per token balance, ``side`` pre/post, 0-based position.

    One scan: each transaction yields its two sides, each side its balances.
    """
    txs = tx_rows(raw, signatures="transaction.signatures",
                  pre="meta.pre_token_balances", post="meta.post_token_balances")
    sides = F.array(*[F.struct(F.lit(side).alias("side"),
                               X.normalise_token_balances(side).alias("list"))
                      for side in ("pre", "post")])
    per_side = txs.select("slot", X.first_or_null("signatures").alias("signature"),
                          F.explode(sides).alias("s"))
    return (per_side.select("slot", "signature", F.col("s.side").alias("side"),
                            F.posexplode("s.list").alias("position", "b"))
            .select("slot", "signature", "side", F.col("position").cast("long").alias("position"),
                    "b.*"))


def tx_rewards(raw: DataFrame) -> DataFrame:
    """P10 long form: rewards inside a transaction's meta, tagged with slot."""
    txs = tx_rows(raw, signatures="transaction.signatures", rewards="meta.rewards")
    return (txs.select(X.first_or_null("signatures").alias("signature"),
                       F.posexplode(X.tag_rewards("rewards", F.col("slot"))).alias("position", "r"))
            .select(F.col("r.slot").alias("slot"), "signature",
                    F.col("position").cast("long").alias("position"),
                    "r.pubkey", "r.lamports", "r.post_balance", "r.reward_type", "r.commission"))


def _instruction_cols(keys, signature, index, ins, is_inner, parent):
    return [
        F.col("slot"),
        signature.alias("tx_signature"),
        index.cast("long").alias("instruction_index"),
        ins["program_id_index"].alias("program_id_index"),
        X.key_at(keys, ins["program_id_index"]).alias("program_id"),
        X.resolve_accounts(keys, ins["accounts"]).alias("accounts"),
        ins["data"].alias("data"),
        (is_inner if not isinstance(is_inner, bool) else F.lit(is_inner)).alias("is_inner"),
        parent.cast("long").alias("parent_index"),
    ]


def _ins_rows(raw: DataFrame, top: bool = True, inner: bool = True) -> DataFrame:
    paths = {"signatures": "transaction.signatures", "keys": "transaction.message.account_keys"}
    if top:
        paths["top"] = "transaction.message.instructions"
    if inner:
        paths["inner"] = "meta.inner_instructions"
    return tx_rows(raw, False, **paths).withColumn("sig", X.first_or_null("signatures"))


def instructions_top(raw: DataFrame) -> DataFrame:
    """Top-level instructions, 0-based position, not inner, no parent."""
    rows = _ins_rows(raw, inner=False).select(
        "slot", "sig", "keys", F.posexplode("top").alias("idx", "ins"))
    return rows.select(*_instruction_cols(F.col("keys"), F.col("sig"), F.col("idx"),
                                          F.col("ins"), False, F.lit(None)))


def instructions_inner(raw: DataFrame) -> DataFrame:
    """Inner instructions; group ``index`` -> parent_index, position inside the group."""
    groups = _ins_rows(raw, top=False).select("slot", "sig", "keys", F.explode("inner").alias("g"))
    rows = groups.select("slot", "sig", "keys", F.col("g.index").alias("parent"),
                         F.posexplode("g.instructions").alias("idx", "ins"))
    return rows.select(*_instruction_cols(F.col("keys"), F.col("sig"), F.col("idx"),
                                          F.col("ins"), True, F.col("parent")))


INS_T = "struct<program_id_index:bigint,accounts:array<bigint>,data:string>"
ENTRY_T = f"array<struct<idx:int,parent:bigint,inner:boolean,ins:{INS_T}>>"


def instructions(raw: DataFrame, one_pass: bool = True) -> DataFrame:
    """Top-level and inner instructions as one table.

    ``one_pass`` builds, per transaction, one array of (position, parent,
    inner flag, instruction) and explodes it: a single scan of the block
    rows.  Otherwise two ``posexplode`` plans are unioned (two scans).
    """
    if not one_pass:
        return instructions_top(raw).unionByName(instructions_inner(raw))
    top = F.transform("top", lambda ins, i: F.struct(
        i.alias("idx"), F.lit(None).cast("long").alias("parent"),
        F.lit(False).alias("inner"), ins.alias("ins")))
    # Each group's list is coalesced first: ``flatten`` is NULL if any part is.
    inner = F.flatten(F.transform("inner", lambda g: F.coalesce(F.transform(
        g["instructions"], lambda ins, i: F.struct(
            i.alias("idx"), g["index"].alias("parent"),
            F.lit(True).alias("inner"), ins.alias("ins"))), F.array().cast(ENTRY_T))))
    every = F.concat(F.coalesce(top, F.array().cast(ENTRY_T)),
                     F.coalesce(inner, F.array().cast(ENTRY_T)))
    keep = S.carried(raw.columns)
    rows = _ins_rows(raw).select("slot", *keep, "sig", "keys", F.explode(every).alias("e"))
    e = F.col("e")
    return rows.select(*_instruction_cols(F.col("keys"), F.col("sig"), e["idx"], e["ins"],
                                          e["inner"], e["parent"]), *keep)


def program_ids(raw: DataFrame) -> DataFrame:
    """Account-index -> program key per instruction (NULL out of range)."""
    return instructions(raw).select("slot", "tx_signature", "is_inner", "parent_index",
                                    "instruction_index", "program_id_index", "program_id")


def resolved_accounts(raw: DataFrame) -> DataFrame:
    """P15 long form: each resolved account of each instruction, order kept."""
    return (instructions(raw)
            .select("slot", "tx_signature", "is_inner", "parent_index", "instruction_index",
                    F.posexplode("accounts").alias("account_position", "account"))
            .withColumn("account_position", F.col("account_position").cast("long")))


def rewards(raw: DataFrame) -> DataFrame:
    """One row per block reward, tagged with slot."""
    keep = S.carried(raw.columns)
    return raw.select("slot", *keep, F.inline("rewards")).select(
        *[F.col(f.name) for f in S.REWARDS.fields], *keep)


# Item list of a block row that each row table is built from.
ITEMS = {"transactions": "transactions", "instructions": "transactions", "rewards": "rewards"}


# Items of a block row that one task builds rows from, at most.
HOT_BLOCK_ITEMS = 20_000


def most_items(raw: DataFrame):
    """The larger of a block row's transaction and reward counts, reading one leaf of each."""
    def n(c):
        return F.coalesce(F.when(c.isNotNull(), F.size(c)), F.lit(0))
    return F.greatest(n(F.col("transactions")["transaction"]["signatures"]), n(F.col("rewards")["pubkey"]))


def spread_hot_blocks(raw: DataFrame, items: str = "transactions", chunk: int = HOT_BLOCK_ITEMS) -> DataFrame:
    """(slot, items) with every block of more than ``chunk`` items cut into
    slices of ``chunk``, and those slices hash-spread over tasks.

    A block is one row, so without this its whole explode and write would run
    in one task.  Only the hot rows move; the others stay where they are.  The
    row tables do not depend on an item's place in the block, so building them
    from the slices gives the same rows.
    """
    leaf = F.col(items)["transaction"]["signatures"] if items == "transactions" else F.col(items)["pubkey"]
    n = F.coalesce(F.when(leaf.isNotNull(), F.size(leaf)), F.lit(0))
    keep = S.carried(raw.columns)
    cold = raw.where(n <= chunk).select("slot", *keep, items)
    hot = (raw.where(n > chunk)
           .select("slot", *keep, items,
                   F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int"))).alias("part"))
           .select("slot", *keep, "part", F.slice(items, F.col("part") * chunk + 1, chunk).alias(items))
           .repartition("slot", "part")
           .drop("part"))
    return cold.unionByName(hot)


BUILDERS = {
    "blocks": blocks,
    "transactions": transactions,
    "instructions": instructions,
    "rewards": rewards,
}


def flatten(raw: DataFrame, tables=S.TABLE_NAMES) -> dict[str, DataFrame]:
    """build only the requested tables (lazy plans; nothing else is computed)."""
    return {t: BUILDERS[t](raw) for t in tables}
