"""The slot-coverage index of a store: runs of stored slots, kept up by batch.

``record`` adds a batch's runs after the batch has been written; ``coverage``
reads the index merged, ``missing`` the slots between the runs.  Neither reads
the slot columns of the tables: the index is about as long as the tables have
gaps.  Recording a batch again changes nothing but the index's length, which
``compact`` brings back to the fewest runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import coverage as C
from ..operators import progress as G
from ..session import fresh_path, remove_path
from . import sink as K

INDEX = "_slot_runs"
DDL = "table_name string, first_slot bigint, last_slot bigint"


def _index(spark: SparkSession, store: K.LedgerStore) -> DataFrame:
    name = store.fqn(INDEX)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({DDL}) USING {store.fmt}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def batch_runs(raw: DataFrame, store: K.LedgerStore) -> DataFrame:
    """Runs of the slots for which the batch gives a table rows (array sizes, no explode)."""
    rows = G._long(G.expected_rows(raw), store.tables).where("expected_rows > 0").select("table_name", "slot")
    return C.merged(C.runs_of(rows), store.bucket_size)


def record(raw: DataFrame, store: K.LedgerStore) -> None:
    """Add the runs of a written batch."""
    _index(raw.sparkSession, store)
    batch_runs(raw, store).select(*C.RUN).write.insertInto(store.fqn(INDEX))


def coverage(spark: SparkSession, store: K.LedgerStore) -> DataFrame:
    """The merged runs of every table."""
    return C.merged(_index(spark, store), store.bucket_size)


def missing(spark: SparkSession, store: K.LedgerStore) -> DataFrame:
    """Runs of slots between the stored ones, per table."""
    return C.gaps(coverage(spark, store), store.bucket_size)


def last_processed(spark: SparkSession, store: K.LedgerStore) -> int | None:
    """A2 from the index: the least of the tables' last slots, None when a table has none."""
    last = {r.table_name: r.last for r in _index(spark, store).groupBy("table_name").agg(F.max("last_slot").alias("last")).collect()}
    return min((last[t] for t in store.tables), default=None) if set(store.tables) <= set(last) else None


def compact(spark: SparkSession, store: K.LedgerStore) -> None:
    """Replace the index by its merged runs."""
    stage = fresh_path(spark, "slot-runs")
    coverage(spark, store).select(*C.RUN).write.parquet(stage)
    spark.read.schema(DDL).parquet(stage).write.insertInto(store.fqn(INDEX), overwrite=True)
    spark.catalog.refreshTable(store.fqn(INDEX))
    remove_path(spark, stage)
