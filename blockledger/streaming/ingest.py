"""Continuous ingest (M3) and per-batch metrics (M8) with Structured Streaming.

New landed block files become micro-batches; each batch goes through the same
idempotent multi-table append as a backfill (``foreachBatch``).  Replays after
a failure -- or a run with a lost checkpoint -- add nothing, because the sink
skips slots a table already holds.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..functions.tolerant import keep_readable_items
from ..operators import progress as G
from ..plans import backfill as M
from ..plans import sink as K
from ..plans.backfill import LANDING_REJECTS  # noqa: F401
from ..session import fresh_path, remove_path
from ..sources.landed import stream_blocks

METRICS_TABLE = "_batch_metrics"
PENDING_TABLE = "_pending_tips"
# Landed bytes per micro-batch unless told otherwise: bounds what one batch persists.
DEFAULT_BYTES_PER_TRIGGER = 16 << 30
METRICS_DDL = ("batch_id bigint, table_name string, input_rows bigint, "
               "min_slot bigint, max_slot bigint, duration_ms bigint")


def _metrics_name(store: K.LedgerStore) -> str:
    return store.fqn(METRICS_TABLE)


def ensure_metrics_table(spark: SparkSession, store: K.LedgerStore) -> str:
    name = _metrics_name(store)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({METRICS_DDL}) USING {store.fmt}")
    return name


def _ensure_pending(spark: SparkSession, store: K.LedgerStore) -> str:
    name = store.fqn(PENDING_TABLE)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({K._ddl(S.RAW_BLOCK)}, batch_id bigint) "
              f"USING {store.fmt} PARTITIONED BY (batch_id)")
    spark.catalog.refreshTable(name)
    return name


def _hold_tip(raw: DataFrame, store: K.LedgerStore, batch_id: int) -> DataFrame:
    """One-slot lag, first phase: hold the newest block under this batch's id.

    A batch takes in its own rows and all held ones, holds the rows of the
    newest slot and gives back those below it.  Nothing held before is touched
    here: rows held by earlier batches go only when this batch has been written
    (``_retire_held``), and this batch's are only ever added to.  So a crash at
    any point leaves what a replay needs, and a replay finds the same tip.
    """
    spark = raw.sparkSession
    name = _ensure_pending(spark, store)
    cols = [f.name for f in S.RAW_BLOCK.fields]
    held = spark.table(name)
    both = raw.select(*cols).unionByName(held.select(*cols))
    tip = both.agg(F.max("slot")).first()[0]
    if tip is None:
        return raw.limit(0)
    h = F.xxhash64(*cols)
    there = held.where(F.col("batch_id") == batch_id).select(h.alias("_h"))
    stage = fresh_path(spark, "pending-tip")
    # One file, so that it is there whole or not at all.
    (both.where(F.col("slot") == tip).distinct().withColumn("_h", h).join(there, "_h", "left_anti")
     .select(*cols).coalesce(1).write.parquet(stage))
    new = spark.read.schema(S.RAW_BLOCK).parquet(stage)
    new.withColumn("batch_id", F.lit(batch_id).cast("long")).write.insertInto(name)
    remove_path(spark, stage)
    spark.catalog.refreshTable(name)
    return both.where(F.col("slot") < tip)


def _retire_held(spark: SparkSession, store: K.LedgerStore, batch_id: int) -> None:
    """Second phase, after the write: rows that other batches held are stored now, or held by this one."""
    name = store.fqn(PENDING_TABLE)
    old = [r[0] for r in spark.table(name).select("batch_id").distinct().collect() if r[0] != batch_id]
    for b in old:  # the batch before, as a rule
        if store.fmt in ("parquet", "orc", "json", "csv"):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (batch_id = {b})")
        else:
            spark.sql(f"DELETE FROM {name} WHERE batch_id = {b}")
    spark.catalog.refreshTable(name)


def process_batch(batch: DataFrame, batch_id: int, store: K.LedgerStore,
                  record_metrics: bool = True, hold_tip: bool = True,
                  start_slot: int | None = None, end_slot: int | None = None) -> None:
    """One micro-batch: log unreadable lines, write all enabled tables, record its metrics.

    ``hold_tip`` keeps the newest slot back until a newer one lands (the
    batch loop's ``slot < tip`` rule, applied to a stream).  Logged lines and
    metrics are added once, so a replayed batch repeats neither.  The bounds
    (inclusive) hold for the blocks; lines are logged whatever their slot.
    """
    t0 = time.time()
    spark = batch.sparkSession
    if S.CORRUPT_COLUMN in batch.columns:
        # Held with the items of flagged lines already read, as every job of the batch uses them.
        batch = keep_readable_items(batch)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        raw = batch.where(F.col("slot").isNotNull()).where(G.slot_range_filter(start_slot, end_slot, None))
        if S.CORRUPT_COLUMN in batch.columns:
            # E1 in the stream: flagged lines are logged; a block that still
            # parsed a slot is kept without the items that cannot be read.
            # Counting them reads the whole batch, so all its files are parsed at once and held.
            flagged = F.col(S.CORRUPT_COLUMN).isNotNull()
            if batch.agg(F.count(S.CORRUPT_COLUMN)).first()[0]:
                M.log_rejected_lines(batch.where(flagged).select("slot", F.col(S.CORRUPT_COLUMN).alias("record")), store)
            raw = raw.drop(S.CORRUPT_COLUMN)
        ready = raw
        if hold_tip:
            ready = _hold_tip(raw, store, batch_id)
        M.write(ready, store)
        if record_metrics:
            _record_metrics(raw, batch_id, store, int((time.time() - t0) * 1000))
        if hold_tip:
            _retire_held(spark, store, batch_id)
    finally:
        batch.unpersist()


def _record_metrics(raw: DataFrame, batch_id: int, store: K.LedgerStore, ms: int) -> None:
    """M8: per table the rows the batch took in; a batch already recorded is not repeated."""
    spark = raw.sparkSession
    name = ensure_metrics_table(spark, store)
    spark.catalog.refreshTable(name)
    sums = [F.coalesce(F.sum(t), F.lit(0)).cast("long").alias(t) for t in store.tables]
    stats = G.expected_rows(raw).agg(F.min("slot").alias("min_slot"), F.max("slot").alias("max_slot"), *sums)
    pairs = ", ".join(f"'{t}', `{t}`" for t in store.tables)
    new = stats.selectExpr(f"cast({batch_id} as bigint) as batch_id",
                           f"stack({len(store.tables)}, {pairs}) as (table_name, input_rows)",
                           "min_slot", "max_slot", f"cast({ms} as bigint) as duration_ms")
    same = ["batch_id", "table_name", "input_rows", "min_slot", "max_slot"]
    seen = {tuple(r) for r in spark.table(name).where(F.col("batch_id") == batch_id).select(*same).distinct().collect()}
    rows = [r for r in new.collect() if tuple(r[c] for c in same) not in seen]  # one row a table
    if rows:
        spark.createDataFrame(rows, new.schema).coalesce(1).select(*spark.table(name).columns).write.insertInto(name)


def continuous_ingest(spark: SparkSession, landing: str, store: K.LedgerStore,
                      checkpoint: str, fmt: str = "json", available_now: bool = False,
                      processing_time: str = "1 second",
                      max_files_per_trigger: int | None = None,
                      record_metrics: bool = True, start_slot: int | None = None,
                      end_slot: int | None = None, hold_tip: bool = True,
                      max_bytes_per_trigger: int = DEFAULT_BYTES_PER_TRIGGER) -> StreamingQuery:
    """M3: follow the landing folder; ``available_now`` drains it and stops.

    ``start_slot`` / ``end_slot`` bound the slots taken (inclusive).  Each
    micro-batch takes at most ``max_bytes_per_trigger`` of landed files, or
    ``max_files_per_trigger`` files where that is given, so a backlog is drained
    in bounded batches.  The newest slot waits for a newer one (``hold_tip``),
    as in a batch run.
    """
    K.ensure_tables(spark, store)
    if record_metrics:
        ensure_metrics_table(spark, store)
    src = stream_blocks(spark, landing, fmt, max_files_per_trigger, max_bytes_per_trigger)
    wanted = G.slot_range_filter(start_slot, end_slot, None)
    if S.CORRUPT_COLUMN in src.columns:
        # Unreadable lines may have no slot; they are logged all the same.
        wanted = F.coalesce(wanted, F.lit(False)) | F.col(S.CORRUPT_COLUMN).isNotNull()
    src = src.where(wanted)
    w = (src.writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, store, record_metrics, hold_tip, start_slot, end_slot))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def batch_metrics(spark: SparkSession, store: K.LedgerStore) -> DataFrame:
    """M8: per batch and table, rows taken in, slot span and batch time."""
    name = _metrics_name(store)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def progress_rows(query: StreamingQuery) -> list[dict]:
    """M8 from the engine: batch id, input rows and duration of recent batches."""
    return [{"batch_id": p["batchId"], "num_input_rows": p["numInputRows"],
             "duration_ms": p.get("durationMs", {}).get("triggerExecution")}
            for p in query.recentProgress]
