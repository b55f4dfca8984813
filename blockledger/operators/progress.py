"""Progress over stored tables: max slot, last processed slot, start position,
skipped slots and per-table missing slots (A1, A2, S2, M1, M5, R5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

#: The words a start setting may be.
START_MODES = ("genesis", "latest", "last_processed")


def max_slot(df: DataFrame) -> DataFrame:
    """A1: global max slot (partial + final aggregate)."""
    return df.agg(F.max("slot").alias("max_slot"))


def max_slots(raw: DataFrame, tables=S.TABLE_NAMES) -> DataFrame:
    """A1 for tables still to be built: per table the max slot that has rows in it.

    Taken from the block rows (``expected_rows``), so no table is built.
    """
    exp = expected_rows(raw)
    top = exp.agg(*[F.max(F.when(F.col(t) > 0, F.col("slot"))).alias(t) for t in tables])
    pairs = ", ".join(f"'{t}', `{t}`" for t in tables)
    return top.selectExpr(f"stack({len(tables)}, {pairs}) as (table_name, max_slot)")


def chain_tip(raw: DataFrame) -> DataFrame:
    """Latest available slot of a block source."""
    return raw.agg(F.max("slot").alias("tip_slot"))


def combine_maxima(spark: SparkSession, maxima: dict[str, DataFrame | None]) -> DataFrame:
    """Min over tables of their one-row ``max_slot`` frames; NULL if any is NULL/missing."""
    null = spark.range(1).select(F.lit(None).cast("long").alias("last_processed_slot"))
    if not maxima or any(df is None for df in maxima.values()):
        return null
    n = len(maxima)
    return (reduce(DataFrame.unionByName, [df.select(F.col("max_slot").alias("m"))
                                           for df in maxima.values()])
            .agg(F.when(F.count("m") == n, F.min("m")).alias("last_processed_slot")))


def last_processed_slot(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """A2: min over the enabled tables of max(slot).

    NULL when no table is enabled, or any enabled table is missing (None) or
    empty.  One plan: the per-table maxima are unioned and reduced once.
    """
    return combine_maxima(spark, {t: None if df is None else max_slot(df)
                                  for t, df in tables.items()})


def last_processed_of(raw: DataFrame, tables=S.TABLE_NAMES) -> DataFrame:
    """A2 for tables still to be built, from the block rows."""
    return max_slots(raw, tables).agg(
        F.when(F.count("max_slot") == len(tables), F.min("max_slot")).alias("last_processed_slot"))


def parse_start(value) -> object:
    """Validate a start/end setting: non-negative int or one of START_MODES."""
    if isinstance(value, bool):
        raise ValueError(f"invalid slot setting {value!r}")
    if isinstance(value, int) and value >= 0:
        return value
    if isinstance(value, str) and value.lower() in START_MODES:
        return value.lower()
    raise ValueError(f"cannot start at {value!r}: give a slot from 0 on or one of {', '.join(START_MODES)}")


def parse_end(value, tip: int | None):
    """End setting: a non-negative int, None (no end) or 'latest' (tip snapshot)."""
    if value is None:
        return None
    if isinstance(value, str) and value.lower() == "latest":
        return tip
    if isinstance(value, int) and not isinstance(value, bool) and value >= 0:
        return value
    raise ValueError(f"invalid end setting {value!r}: a non-negative integer, 'latest' or None")


def start_position(mode, tip: DataFrame, last_processed: DataFrame) -> DataFrame:
    """M1: one-row frame with ``start_slot`` for a start setting.

    genesis -> 0; latest -> tip; last_processed -> A2 + 1, or 0 when NULL;
    an integer -> itself.
    """
    mode = parse_start(mode)
    nul = F.lit(None).cast("long")
    # Two one-row inputs merged by a union + aggregate (no join needed).
    both = (tip.select(F.col("tip_slot").alias("t"), nul.alias("p"))
            .unionByName(last_processed.select(nul.alias("t"),
                                               F.col("last_processed_slot").alias("p")))
            .agg(F.max("t").alias("tip_slot"), F.max("p").alias("last_processed_slot")))
    if mode == "genesis":
        start = F.lit(0).cast("long")
    elif mode == "latest":
        start = F.col("tip_slot")
    elif mode == "last_processed":
        start = F.coalesce(F.col("last_processed_slot") + 1, F.lit(0).cast("long"))
    else:
        start = F.lit(int(mode)).cast("long")
    return both.select(F.lit(str(mode)).alias("start_mode"), start.alias("start_slot"))


def slot_range_filter(start: int | None, end: int | None, tip: int | None,
                      bucket_size: int | None = None) -> Column:
    """``start <= slot <= end`` and ``slot < tip`` (each bound optional).

    With ``bucket_size`` the matching ``slot_bucket`` predicate is added so a
    bucketed table prunes partitions (a filter on ``slot`` alone does not).
    """
    cond = F.lit(True)
    lo = start
    hi = end
    if tip is not None:
        hi = tip - 1 if hi is None else min(hi, tip - 1)
    if lo is not None:
        cond = cond & (F.col("slot") >= lo)
    if hi is not None:
        cond = cond & (F.col("slot") <= hi)
    if bucket_size:
        b = F.col(S.partition_column())
        if lo is not None:
            cond = cond & (b >= lo // bucket_size)
        if hi is not None:
            cond = cond & (b <= hi // bucket_size)
    return cond


def skipped_slots(blocks: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """M5: slots in [start, end] (default: the blocks' span) with no block."""
    if start is None or end is None:
        r = blocks.agg(F.min("slot").alias("lo"), F.max("slot").alias("hi")).first()
        start = r["lo"] if start is None else start
        end = r["hi"] if end is None else end
    spark = blocks.sparkSession
    if start is None or end is None or end < start:
        return spark.range(0).select(F.col("id").alias("slot"))
    every = spark.range(start, end + 1).select(F.col("id").alias("slot"))
    return every.join(blocks.select("slot"), "slot", "left_anti")


def n_elements(arr: Column) -> Column:
    """Element count, 0 for a missing array (ANSI-independent)."""
    return F.coalesce(F.when(arr.isNotNull(), F.size(arr)), F.lit(0))


def _sum_sizes(arrays: Column) -> Column:
    """Sum of element counts of an array of arrays (missing arrays count 0)."""
    return F.coalesce(F.aggregate(arrays, F.lit(0).cast("long"),
                                  lambda acc, x: acc + n_elements(x).cast("long")), F.lit(0).cast("long"))


def expected_rows(raw: DataFrame) -> DataFrame:
    """Per slot, the rows each table should hold, from the block rows alone.

    Counts the rows that E2 accepts: a block with every required column, and
    the transactions and instructions of a transaction with a first signature
    (only the instructions where the transaction's own values could not be read).
    Columns: slot, blocks, transactions, instructions, rewards (no explode).
    Counts come from field paths (``transactions.transaction.signatures``,
    ``...message.instructions``, ``meta.inner_instructions``), so a Parquet
    landing reads only those nested fields, not whole transactions.
    """
    t = F.col("transactions")
    sigs = t["transaction"]["signatures"]
    known = F.col("slot").isNotNull()
    parts = F.arrays_zip(sigs.alias("s"), t["transaction"]["message"]["instructions"].alias("top"),
                         t["meta"]["inner_instructions"].alias("groups"), t[S.UNREADABLE].alias("u"))
    signed = lambda s: F.get(s, F.lit(0)).isNotNull()
    per_tx = F.transform(parts, lambda x: F.when(
        signed(x["s"]), n_elements(x["top"]).cast("long") + _sum_sizes(x["groups"]["instructions"])))
    whole = F.lit(True)
    for c in S.required_columns("blocks"):
        whole = whole & F.col(c).isNotNull()

    def count(c: Column) -> Column:
        return F.when(known, c).otherwise(0).cast("long")
    return raw.select(
        "slot",
        F.when(whole, 1).otherwise(0).cast("long").alias("blocks"),
        count(n_elements(F.filter(parts, lambda x: signed(x["s"]) & ~F.coalesce(x["u"], F.lit(False))))).alias("transactions"),
        count(F.coalesce(F.aggregate(per_tx, F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(
            x, F.lit(0).cast("long"))), F.lit(0).cast("long"))).alias("instructions"),
        count(n_elements(F.col("rewards")["pubkey"])).alias("rewards"))


def _long(df: DataFrame, tables) -> DataFrame:
    pairs = ", ".join(f"'{t}', `{t}`" for t in tables)
    return df.selectExpr("slot", f"stack({len(tables)}, {pairs}) as (table_name, expected_rows)")


def missing_by_table(raw: DataFrame, stored: dict[str, DataFrame]) -> DataFrame:
    """Per table, slots whose stored row count differs from what raw implies.

    An empty slot can be right (few rewards), so the comparison is against the
    count expected from the block rows, not against presence.
    """
    tables = list(stored)
    exp = _long(expected_rows(raw).select("slot", *tables), tables)
    have = reduce(DataFrame.unionByName, [
        df.groupBy("slot").agg(F.count(F.lit(1)).alias("stored_rows"))
          .select("slot", F.lit(t).alias("table_name"), "stored_rows")
        for t, df in stored.items()])
    j = exp.join(have, ["slot", "table_name"], "full_outer")
    e = F.coalesce(F.col("expected_rows"), F.lit(0))
    s = F.coalesce(F.col("stored_rows"), F.lit(0))
    return (j.where(e != s)
            .select("table_name", "slot", e.cast("long").alias("expected_rows"),
                    s.cast("long").alias("stored_rows")))
