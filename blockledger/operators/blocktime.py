"""Missing block times (R1) and date partitioning on the filled time (R2).

A gap is filled by linear interpolation between the nearest earlier and later
known times (by slot); before the first / after the last known time the
nearest one is carried.  No global window over the blocks: the fill runs per
``slot_bucket`` window, and the edges each bucket needs from outside (last
known time before it, first after it) come from a one-row-per-bucket summary
whose size is bounded by span / bucket size and checked before broadcasting.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import unix_date

FILL_BUCKET_SLOTS = 100_000      # slots per fill window
GROUP = 1_000                    # buckets per window of the bucket summary


def _neighbours(summary: DataFrame, key: str, group: str | None) -> DataFrame:
    """(key, before, after): the last known time of the buckets before, the first of those after.

    ``summary`` has (key, first_known, last_known); with ``group`` only buckets of
    the same group are looked at.
    """
    w = Window.partitionBy(group).orderBy(key) if group else Window.orderBy(key)
    return summary.select(
        "*", F.last("last_known", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.first("first_known", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("after"))


def _summary(df: DataFrame, key: str, first, last, order) -> DataFrame:
    return df.groupBy(key).agg(F.min_by(first, F.when(first.isNotNull(), order)).alias("first_known"),
                               F.max_by(last, F.when(last.isNotNull(), order)).alias("last_known"))


def fill_block_time(blocks: DataFrame, bucket_slots: int = FILL_BUCKET_SLOTS, keep: tuple = ()) -> DataFrame:
    """(slot, block_time, block_time_filled, block_time_is_filled), and the columns to ``keep``.

    Windows over slots stay within a bucket; what a bucket needs from its
    neighbours comes from one row for each bucket, looked up within groups of
    ``GROUP`` buckets, and from one row for each group (1e8 slots at the default
    sizes), so no window over rows or buckets runs in a single task.
    """
    b = blocks.select("slot", "block_time", *keep, F.floor(F.col("slot") / bucket_slots).cast("long").alias("fb"))
    known = F.when(F.col("block_time").isNotNull(), F.struct(
        F.col("slot").alias("s"), F.col("block_time").alias("t")))
    per_bucket = _summary(b, "fb", known, known, F.col("slot")).withColumn("fg", F.floor(F.col("fb") / GROUP).cast("long"))
    per_group = _neighbours(_summary(per_bucket, "fg", F.col("first_known"), F.col("last_known"), F.col("fb")), "fg", None)
    edges = (_neighbours(per_bucket, "fb", "fg").alias("e")
             .join(per_group.select("fg", F.col("before").alias("gb"), F.col("after").alias("ga")), "fg")
             .select("fb", F.coalesce("before", "gb").alias("before"), F.coalesce("after", "ga").alias("after")))

    w = Window.partitionBy("fb").orderBy("slot")
    filled = (b.join(edges, "fb")
              .select("slot", "block_time", *keep,
                      F.coalesce(F.last(known, ignorenulls=True)
                                 .over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                 F.col("before")).alias("p"),
                      F.coalesce(F.first(known, ignorenulls=True)
                                 .over(w.rowsBetween(1, Window.unboundedFollowing)),
                                 F.col("after")).alias("n")))
    interp = F.expr("p.t + ((n.t - p.t) * (slot - p.s)) div (n.s - p.s)")
    value = (F.when(F.col("block_time").isNotNull(), F.col("block_time"))
             .when(F.col("p").isNotNull() & F.col("n").isNotNull(), interp)
             .when(F.col("p").isNotNull(), F.col("p.t"))
             .otherwise(F.col("n.t")))
    return filled.select("slot", "block_time", *keep, value.cast("long").alias("block_time_filled"),
                         F.col("block_time").isNull().alias("block_time_is_filled"))


def with_block_date(df: DataFrame, filled: DataFrame) -> DataFrame:
    """R2: add ``block_date`` (UTC date of the filled block time) by slot to a row table.

    The (slot, block_date) side is one row per slot, far smaller than the
    rows, and AQE picks broadcast or sort-merge on measured size.
    """
    dates = filled.select("slot", unix_date("block_time_filled").alias("block_date"))
    return df.join(dates, "slot", "left")


def dated_blocks(blocks: DataFrame, bucket_slots: int = FILL_BUCKET_SLOTS) -> DataFrame:
    """R2 for ``blocks`` itself: its columns are carried through the fill, without a join."""
    keep = tuple(c for c in blocks.columns if c not in ("slot", "block_time"))
    return (fill_block_time(blocks, bucket_slots, keep)
            .select(*blocks.columns, unix_date("block_time_filled").alias("block_date")))
