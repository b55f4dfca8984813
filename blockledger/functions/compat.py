"""The all-string table schema (nested values as JSON text).

Stored tables keep native nested types; this projection renders the JSON-text
form on demand, reproducing the string schema's conventions:

* balances: JSON list, NULL when there is no meta or the list is empty;
* token balances / transaction rewards: NULL without meta, the text ``null``
  when meta is present but the list is missing or empty;
* log messages: NULL without meta, ``null`` when meta has none;
* a missing reward type is the text ``None``;
* instruction accounts: always a JSON list (``[]`` when empty).

Separators are the compact JSON ones (``[1,2]``); compare parsed values,
not bytes, with text written by other JSON encoders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON_OPTS = {"ignoreNullFields": "false"}
MISSING_TYPE_TEXT = "None"    # fixed value: text of a missing reward type
NULL_TEXT = "null"            # fixed value: JSON text of a missing list


def json_text(c: Column) -> Column:
    return F.to_json(c, JSON_OPTS)


def _with_type_text(rewards: Column) -> Column:
    return F.transform(rewards, lambda r: F.struct(
        r["slot"].alias("slot"), r["pubkey"].alias("pubkey"), r["lamports"].alias("lamports"),
        r["post_balance"].alias("post_balance"),
        F.coalesce(r["reward_type"], F.lit(MISSING_TYPE_TEXT)).alias("reward_type"),
        r["commission"].alias("commission")))


def transactions_as_text(tx: DataFrame) -> DataFrame:
    """Typed ``transactions`` -> the string schema (16 columns, same order)."""
    has_meta = F.col("success").isNotNull()   # success is NULL exactly when meta is

    def listed(c: Column) -> Column:
        return F.when(has_meta, F.coalesce(json_text(c), F.lit(NULL_TEXT)))

    out = []
    for name in tx.columns:
        c = F.col(name)
        if name in ("pre_balances", "post_balances"):
            out.append(json_text(c).alias(name))
        elif name in ("pre_token_balances", "post_token_balances", "log_messages"):
            out.append(listed(c).alias(name))
        elif name == "rewards":
            out.append(listed(_with_type_text(c)).alias(name))
        else:
            out.append(c)
    return tx.select(*out)


def instructions_as_text(ins: DataFrame) -> DataFrame:
    return ins.withColumn("accounts", F.coalesce(json_text(F.col("accounts")), F.lit("[]")))


def rewards_as_text(rw: DataFrame) -> DataFrame:
    return rw.withColumn("reward_type", F.coalesce(F.col("reward_type"), F.lit(MISSING_TYPE_TEXT)))


AS_TEXT = {
    "transactions": transactions_as_text,
    "instructions": instructions_as_text,
    "rewards": rewards_as_text,
}


def as_text(table: str, df: DataFrame) -> DataFrame:
    return AS_TEXT.get(table, lambda d: d)(df)
