"""Slot coverage as runs: which slots a table holds, as few intervals as possible.

A run is (table_name, first_slot, last_slot), both ends included; a single slot
is a run of length one.  Runs are merged inside slot buckets first, where a
window sees one bucket's runs only; of each bucket at most two merged runs touch
its borders, and only those are stitched together over all buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN = ["table_name", "first_slot", "last_slot"]


def runs_of(slots: DataFrame) -> DataFrame:
    """Slots (table_name, slot) as runs of one slot each; rows without a slot are none."""
    slot = F.col("slot").cast("long")
    return slots.where("slot is not null").select("table_name", slot.alias("first_slot"), slot.alias("last_slot")).distinct()


def _islands(runs: DataFrame, *keys: str) -> DataFrame:
    """Overlapping and adjacent runs with equal keys as one."""
    w = Window.partitionBy(*keys).orderBy("first_slot", "last_slot")
    reached = F.max("last_slot").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("first_slot") > reached + 1), 1).otherwise(0)
    return (runs.withColumn("_begins", begins)
            .withColumn("_n", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*keys, "_n").agg(F.min("first_slot").alias("first_slot"), F.max("last_slot").alias("last_slot")).drop("_n"))


def merged(runs: DataFrame, bucket_size: int) -> DataFrame:
    """The fewest runs that cover the same slots; the input may overlap and repeat."""
    b = bucket_size
    cut = (runs.select(*RUN, F.explode(F.sequence(F.expr(f"first_slot div {b}"), F.expr(f"last_slot div {b}"))).alias("b"))
           .select("table_name", "b", F.greatest("first_slot", F.col("b") * b).alias("first_slot"),
                   F.least("last_slot", F.col("b") * b + (b - 1)).alias("last_slot")))
    inside = _islands(cut, "table_name", "b").select(*RUN)
    border = F.expr(f"first_slot % {b} = 0 or last_slot % {b} = {b - 1}")
    return inside.where(~border).unionByName(_islands(inside.where(border), "table_name").select(*RUN))


def gaps(runs: DataFrame, bucket_size: int) -> DataFrame:
    """(table_name, first_slot, last_slot) of the slots between merged runs."""
    runs = runs.withColumn("b", F.expr(f"first_slot div {bucket_size}"))
    each = Window.partitionBy("table_name", "b").orderBy("first_slot")
    over = Window.partitionBy("table_name").orderBy("b")  # one row a bucket
    later = (runs.groupBy("table_name", "b").agg(F.min("first_slot").alias("f"))
             .select("table_name", "b", F.lead("f").over(over).alias("later")))
    nxt = runs.withColumn("next", F.lead("first_slot").over(each)).join(later, ["table_name", "b"])
    nxt = nxt.withColumn("next", F.coalesce("next", "later")).where("next > last_slot + 1")
    return nxt.select("table_name", (F.col("last_slot") + 1).alias("first_slot"), (F.col("next") - 1).alias("last_slot"))
