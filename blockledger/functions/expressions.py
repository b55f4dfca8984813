"""Scalar helpers used inside the flatten operators (all built-in, JVM-side).

Every helper returns a ``Column``; none is a UDF, so the flatten plans stay in
whole-stage codegen where Spark supports it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_empty_or_null(arr: Column | str) -> Column:
    """The array when it has elements, else NULL (missing and empty alike)."""
    a = col(arr)
    return F.when(F.size(a) > 0, a)


def blank_to_null(s: Column | str) -> Column:
    """Text that is missing or empty becomes NULL (Python truthiness of a str)."""
    c = col(s)
    return F.when(F.length(c) > 0, c)


def first_or_null(arr: Column | str) -> Column:
    """First element, NULL for a missing or empty array (ANSI-safe ``get``)."""
    return F.get(col(arr), F.lit(0))


def key_at(keys: Column | str, idx: Column | str) -> Column:
    """Account key at a 0-based index; NULL when the index is past the end."""
    return F.get(col(keys), col(idx).cast("int"))


def resolve_accounts(keys: Column | str, idx_list: Column | str) -> Column:
    """Index list -> key list; indexes past the end are dropped, order kept."""
    k = col(keys)
    return F.transform(F.filter(col(idx_list), lambda a: a < F.size(k)),
                       lambda a: F.get(k, a.cast("int")))


def success_of(err: Column | str, *others: Column | str) -> Column:
    """Whether ``err`` is absent; NULL without meta.

    Meta counts as present when ``err`` or one of its ``others`` (values every
    meta carries, such as the fee) is there, so a reader needs those leaves
    only and not the whole meta.
    """
    e = col(err)
    there = e.isNotNull()
    for o in others:
        there = there | col(o).isNotNull()
    return F.when(there, e.isNull())


def error_of(err: Column | str) -> Column:
    """Text of ``err`` when present and non-empty, else NULL."""
    return blank_to_null(err)


def normalise_token_balances(arr: Column | str) -> Column:
    """Token balances -> 8 flat fields in order; NULL list when missing or empty."""
    def flat(b):
        amt = b["ui_token_amount"]
        return F.struct(
            b["account_index"].alias("account_index"),
            b["mint"].alias("mint"),
            amt["amount"].alias("amount"),
            amt["decimals"].alias("decimals"),
            amt["ui_amount"].alias("ui_amount"),
            amt["ui_amount_string"].alias("ui_amount_string"),
            blank_to_null(b["owner"]).alias("owner"),
            blank_to_null(b["program_id"]).alias("program_id"))
    a = col(arr)
    return F.when(F.size(a) > 0, F.transform(a, flat))


def tag_rewards(arr: Column | str, slot: Column | str) -> Column:
    """Rewards tagged with their slot; NULL list when missing or empty."""
    a, s = col(arr), col(slot)
    return F.when(F.size(a) > 0, F.transform(a, lambda r: F.struct(
        s.alias("slot"),
        r["pubkey"].alias("pubkey"),
        r["lamports"].alias("lamports"),
        r["post_balance"].alias("post_balance"),
        r["reward_type"].alias("reward_type"),
        r["commission"].alias("commission"))))


def slot_bucket(slot: Column | str, bucket_size: int) -> Column:
    """Partition key: ``slot div bucket_size``."""
    s = col(slot)
    return F.floor(s / F.lit(bucket_size)).cast("long")


def unix_date(seconds: Column | str) -> Column:
    """UTC calendar date of epoch seconds, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(col(seconds) / 86400).cast("int"))


def joined_text(arr: Column | str, sep: str = ",") -> Column:
    """Array rendered as ``sep``-joined text (NULL stays NULL)."""
    return F.array_join(col(arr).cast("array<string>"), sep)
