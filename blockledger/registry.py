"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` (through the ledger landed
from them by Spark), so its work grows with the data.  Side-effecting
operators (sinks, backfills, streams) write into a fresh namespace under the
shared folder and return what they stored, read back.

Array columns are rendered as ``,``-joined text or element counts, and nested
lists are returned in long form, so results compare as flat rows.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S
from .functions import compat
from .functions.expressions import joined_text
from .operators import blocktime as R
from .operators import flatten as P
from .operators import progress as G
from .operators import quality as Q
from .plans import backfill as M
from .plans import coverage as V
from .plans import publish as U
from .plans import sink as K
from .session import fresh_namespace, fresh_path
from .sources import landed as L
from .sources import ledger
from .streaming import ingest as ST

# Stored partitions of the registered queries: at least this many slots in each,
# and about this many of them over the span of the input.
LEAST_BUCKET_SLOTS = 250
QUERY_BUCKETS = 256
# A development profile that writes these two tables only.
DEV_TABLES = ("blocks", "transactions")
# Tables whose maxima the last-processed query combines (rewards lag).
PROGRESS_TABLES = ("blocks", "transactions", "rewards")
# A configured integer start slot for the start-position query.
CONFIGURED_START = 100
# Landed bytes a micro-batch of the stream queries takes.
BYTES_PER_TRIGGER = 64 << 20


def raw_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger_raw(spark, sf_dir)


def _bucket_slots(raw: DataFrame) -> int:
    return max(LEAST_BUCKET_SLOTS, (_tip(raw) or 0) // QUERY_BUCKETS + 1)


def _store(raw: DataFrame, tables=S.TABLE_NAMES, prefix="ledger") -> K.LedgerStore:
    return K.LedgerStore(namespace=fresh_namespace(raw.sparkSession, prefix), tables=tuple(tables),
                         bucket_size=_bucket_slots(raw))


def _tip(raw: DataFrame) -> int:
    return G.chain_tip(raw).first()["tip_slot"]


def _tx_flat(tx: DataFrame) -> DataFrame:
    """Typed transactions -> flat columns (arrays as text / element counts)."""
    def n(c):
        return F.when(F.col(c).isNotNull(), F.size(c)).cast("long")
    return tx.select(
        "slot", "signature", "num_required_signatures", "num_readonly_signed_accounts",
        "num_readonly_unsigned_accounts", "recent_blockhash", "success", "error", "fee",
        joined_text("pre_balances").alias("pre_balances"),
        joined_text("post_balances").alias("post_balances"),
        n("pre_token_balances").alias("n_pre_token_balances"),
        n("post_token_balances").alias("n_post_token_balances"),
        joined_text("log_messages").alias("log_messages"),
        n("rewards").alias("n_rewards"),
        "compute_units_consumed")


def _ins_flat(ins: DataFrame) -> DataFrame:
    return ins.withColumn("accounts", joined_text("accounts"))


# ---------------------------------------------------------------- sources

def q_raw_blocks(spark, sf):
    """Blocks read from landed JSON lines under the RAW_BLOCK schema."""
    raw = L.read_blocks(spark, ledger.land_json(spark, sf), fmt="json")
    return raw.select(*[F.col(f.name) for f in S.BLOCKS.fields],
                      G.n_elements(F.col("transactions")).cast("long").alias("n_transactions"),
                      G.n_elements(F.col("rewards")).cast("long").alias("n_rewards"))


def q_chain_tip(spark, sf):
    return G.chain_tip(raw_of(spark, sf))


def q_scan_table(spark, sf):
    raw = raw_of(spark, sf)
    store = _store(raw, ("blocks",))
    K.write_all(raw, store)
    return L.scan_table(spark, store.fqn("blocks")).drop(S.partition_column())


def q_scan_format(spark, sf):
    path = fresh_path(spark, "blocks-parquet")
    raw = raw_of(spark, sf)
    (P.blocks(raw).withColumn(S.partition_column(), F.floor(F.col("slot") / _bucket_slots(raw)).cast("long"))
     .write.partitionBy(S.partition_column()).parquet(path))
    return L.scan_format(spark, path, "parquet").drop(S.partition_column())


def q_block_time_lookup(spark, sf):
    raw = raw_of(spark, sf)
    slots = spark.range(0, _tip(raw) + 1).select(F.col("id").alias("slot"))
    return L.block_time_lookup(P.blocks(raw), slots)


def q_table_exists(spark, sf):
    raw = raw_of(spark, sf)
    store = _store(raw, DEV_TABLES)
    K.write_all(raw, store)
    rows = []
    for t in S.TABLE_NAMES:
        name = store.fqn(t)
        if L.table_exists(spark, name):
            rows.append(K.read_table(spark, store, t).agg(
                F.lit(t).alias("table_name"), F.lit(True).alias("table_exists"),
                F.count(F.lit(1)).cast("long").alias("row_count")))
        else:
            rows.append(spark.range(1).select(
                F.lit(t).alias("table_name"), F.lit(False).alias("table_exists"),
                F.lit(None).cast("long").alias("row_count")))
    return reduce(DataFrame.unionByName, rows)


def q_typed_rows(spark, sf):
    """Rows that arrive as text, cast to the declared schema."""
    rewards = P.rewards(raw_of(spark, sf))
    return Q.conform(rewards.select([F.col(c).cast("string") for c in rewards.columns]), "rewards")


# ---------------------------------------------------------------- sinks

def q_ensure_tables(spark, sf):
    raw = raw_of(spark, sf)
    store = _store(raw)
    K.ensure_tables(spark, store)
    K.ensure_tables(spark, store)          # idempotent: second call is a no-op
    K.write_all(raw, store)
    tables = {t: K.read_table(spark, store, t) for t in store.tables}
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(t).alias("table_name"),
               F.lit(len(df.columns)).cast("long").alias("column_count"),   # as created
               F.count(F.lit(1)).cast("long").alias("row_count"))
        for t, df in tables.items()])


def q_append_table(spark, sf):
    """K2 twice; unsigned transactions are refused both times."""
    raw = ledger.with_faults(raw_of(spark, sf))
    store = _store(raw, ("transactions",))
    K.ensure_tables(spark, store)
    tx = P.transactions(raw)
    K.append_table(tx, store, "transactions")
    K.append_table(tx, store, "transactions")   # replay: adds nothing
    return _tx_flat(K.read_table(spark, store, "transactions"))


def q_write_all(spark, sf):
    raw = raw_of(spark, sf)
    store = _store(raw)
    K.write_all(raw, store)
    return M.stored_counts(spark, store)


def q_show_rows(spark, sf):
    """K6: the first rows of a table, by slot."""
    return P.blocks(raw_of(spark, sf)).orderBy("slot").limit(10)


# ---------------------------------------------------------------- flatten

def q_blocks(spark, sf):
    return P.blocks(raw_of(spark, sf))


def q_transactions(spark, sf):
    return _tx_flat(P.transactions(raw_of(spark, sf)))


def q_tx_status(spark, sf):
    return P.tx_status(raw_of(spark, sf))


def q_token_balances(spark, sf):
    return P.token_balances(raw_of(spark, sf))


def q_tx_rewards(spark, sf):
    return P.tx_rewards(raw_of(spark, sf))


def q_instructions_top(spark, sf):
    return _ins_flat(P.instructions_top(raw_of(spark, sf)))


def q_instructions_inner(spark, sf):
    return _ins_flat(P.instructions_inner(raw_of(spark, sf)))


def q_instructions(spark, sf):
    return _ins_flat(P.instructions(raw_of(spark, sf)))


def q_program_id(spark, sf):
    return P.program_ids(raw_of(spark, sf))


def q_resolve_accounts(spark, sf):
    return P.resolved_accounts(raw_of(spark, sf))


def q_rewards(spark, sf):
    return P.rewards(raw_of(spark, sf))


# ---------------------------------------------------------------- filters / quality

def q_table_selection(spark, sf):
    raw = raw_of(spark, sf)
    store = _store(raw, DEV_TABLES)
    K.write_all(raw, store)
    return M.stored_counts(spark, store)


def q_slot_range(spark, sf):
    """F2 on a stored table: both bounds, the tip and the bucket predicate."""
    raw = raw_of(spark, sf)
    tip = _tip(raw)
    store = _store(raw, ("blocks",))
    K.write_all(raw, store)
    return (K.read_table(spark, store, "blocks")
            .where(G.slot_range_filter(tip // 4, tip // 2, tip, store.bucket_size)).drop(S.partition_column()))


def q_non_empty(spark, sf):
    exp = G.expected_rows(raw_of(spark, sf))
    pairs = ", ".join(f"'{t}', `{t}`" for t in S.TABLE_NAMES)
    return (exp.selectExpr("slot", f"stack({len(S.TABLE_NAMES)}, {pairs}) as (table_name, row_count)")
            .where(F.col("row_count") > 0))


def q_permissive_read(spark, sf):
    """Landed JSON with broken lines, split whole into good blocks and rejected lines."""
    good, _rejected = Q.convert_landed(spark, ledger.land_broken(spark, sf),
                                       fresh_path(spark, "read-lines"))
    return P.blocks(good)


def q_dropped_items(spark, sf):
    """E1 inside a block: items that cannot be read go one by one, their siblings stay."""
    good, _logged = Q.convert_landed(spark, ledger.land_bad_items(spark, sf), fresh_path(spark, "read-lines"))
    value = {"transactions": "fee", "instructions": "program_id_index", "rewards": "lamports",
             "token_balances": "account_index", "tx_rewards": "lamports"}
    rows = reduce(DataFrame.unionByName, [
        getattr(P, t)(good).select(F.lit(t).alias("table_name"), "slot", F.col(c).alias("v")) for t, c in value.items()])
    return rows.groupBy("table_name", "slot").agg(F.count(F.lit(1)).alias("row_count"), F.sum("v").alias("total"))


def q_rejected_rows(spark, sf):
    """E2 in the sink: rows stored and rows set aside, of input that has both."""
    raw = ledger.faulty_raw(spark, sf)
    store = _store(raw)
    K.write_all(raw, store)
    K.write_all(raw, store)                     # replay: adds nothing, neither here nor there
    parts = []
    for t in store.tables:
        name = K.rejects_name(store, t)
        rows = K.read_table(spark, store, t).select(F.lit(1).alias("a"), F.lit(0).alias("r"))
        if L.table_exists(spark, name):
            rows = rows.unionByName(L.scan_table(spark, name).select(F.lit(0).alias("a"), F.lit(1).alias("r")))
        parts.append(rows.agg(F.lit(t).alias("table_name"),
                              F.coalesce(F.sum("a"), F.lit(0)).cast("long").alias("accepted_rows"),
                              F.coalesce(F.sum("r"), F.lit(0)).cast("long").alias("rejected_rows")))
    return reduce(DataFrame.unionByName, parts)


def q_nullability_report(spark, sf):
    return Q.nullability_report(P.flatten(ledger.with_faults(raw_of(spark, sf))))


# ---------------------------------------------------------------- aggregates / sort

def q_max_slot(spark, sf):
    return G.max_slots(raw_of(spark, sf))


def q_last_processed_slot(spark, sf):
    raw = raw_of(spark, sf)
    store = _store(raw, PROGRESS_TABLES)
    K.write_all(raw, store)
    return K.stored_last_processed(spark, store)


def q_order_by_slot(spark, sf):
    return P.blocks(raw_of(spark, sf)).orderBy("slot")


def q_first_blocks(spark, sf):
    return P.blocks(raw_of(spark, sf)).orderBy("slot").limit(10)


def q_json_columns(spark, sf):
    return compat.transactions_as_text(P.transactions(raw_of(spark, sf)))


def q_json_instructions(spark, sf):
    return compat.instructions_as_text(P.instructions(raw_of(spark, sf)))


def q_json_rewards(spark, sf):
    return compat.rewards_as_text(P.rewards(raw_of(spark, sf)))


# ---------------------------------------------------------------- incremental / streaming

def q_start_position(spark, sf):
    raw = raw_of(spark, sf)
    lp = G.last_processed_of(raw, PROGRESS_TABLES)
    tip = G.chain_tip(raw)
    return reduce(DataFrame.unionByName, [
        G.start_position(m, tip, lp) for m in ("genesis", "latest", "last_processed",
                                              CONFIGURED_START)])


def q_bounded_backfill(spark, sf):
    raw = raw_of(spark, sf)
    store = _store(raw)
    M.bounded_backfill(raw, store, 0, _tip(raw) // 2)
    return M.stored_counts(spark, store)


def _streamed(spark, sf) -> K.LedgerStore:
    """The JSON landing drained as a stream; the newest slot waits."""
    store = _store(raw_of(spark, sf))
    q = ST.continuous_ingest(spark, ledger.land_json(spark, sf), store, fresh_path(spark, "stream-ckpt"),
                             available_now=True, max_bytes_per_trigger=BYTES_PER_TRIGGER)
    q.awaitTermination()
    return store


def q_continuous_ingest(spark, sf):
    return M.stored_counts(spark, _streamed(spark, sf))


def q_resume(spark, sf):
    raw = raw_of(spark, sf)
    tip = _tip(raw)
    store = _store(raw)
    M.bounded_backfill(raw, store, 0, tip // 2, tip)
    M.resume(spark, raw, store, None, tip)
    M.resume(spark, raw, store, None, tip)      # nothing new: adds nothing
    return M.stored_counts(spark, store)


def q_skipped_slots(spark, sf):
    return G.skipped_slots(P.blocks(raw_of(spark, sf)))


def q_batch_metrics(spark, sf):
    """M8: rows taken in per table, summed over the batches (their number and times vary)."""
    return (ST.batch_metrics(spark, _streamed(spark, sf)).groupBy("table_name")
            .agg(F.sum("input_rows").cast("long").alias("input_rows")))


# ---------------------------------------------------------------- to-do items

def q_fill_block_time(spark, sf):
    raw = raw_of(spark, sf)
    return R.fill_block_time(P.blocks(raw), bucket_slots=_bucket_slots(raw))


def q_date_partitioning(spark, sf):
    """R2: tables partitioned by date; the date each block is stored under."""
    raw = raw_of(spark, sf)
    store = _store(raw, DEV_TABLES)
    store.by_date = True
    K.write_all(raw, store)
    return K.read_table(spark, store, "blocks").select(
        "slot", F.date_format(S.DATE_COLUMN, "yyyy-MM-dd").alias("block_date"))


def q_parallel_backfill(spark, sf):
    raw = raw_of(spark, sf)
    store = _store(raw)
    M.parallel_backfill(raw, store)
    return M.stored_counts(spark, store)


def q_missing_by_table(spark, sf):
    """R5 after a partial run: blocks complete, the other tables up to mid-way."""
    raw = raw_of(spark, sf)
    half = _tip(raw) // 2
    full = _store(raw, ("blocks",))
    K.write_all(raw, full)
    part = K.LedgerStore(namespace=full.namespace, tables=("transactions", "instructions", "rewards"),
                         bucket_size=full.bucket_size)
    M.bounded_backfill(raw, part, 0, half)
    stored = {t: K.read_table(spark, part, t) for t in part.tables}
    return G.missing_by_table(raw, stored)


def q_repair_missing(spark, sf):
    """R5 repair of a half-done run over input with refused rows: counts, and slots still missing."""
    raw = ledger.faulty_raw(spark, sf)
    store = _store(raw)
    M.bounded_backfill(raw, store, 0, _tip(raw) // 2)
    M.repair_missing(spark, raw, store)
    left = G.missing_by_table(raw, {t: K.read_table(spark, store, t) for t in store.tables})
    left = left.groupBy("table_name").agg(F.count("*").alias("n"))
    return (M.stored_counts(spark, store).join(left, "table_name", "left")
            .withColumn("slots_missing", F.coalesce("n", F.lit(0))).drop("n"))


def _covered(spark, sf):
    """A store written and recorded in two batches that overlap, the later slots first."""
    raw = raw_of(spark, sf)
    store, half = _store(raw), _tip(raw) // 2
    for batch in (raw.where(F.col("slot") >= half - 3), raw.where(F.col("slot") < half)):
        K.write_all(batch, store)
        V.record(batch, store)
    return store


def q_slot_coverage(spark, sf):
    """Runs of stored slots per table, from the index and not from the tables."""
    return V.coverage(spark, _covered(spark, sf))


def q_slot_gaps(spark, sf):
    """Runs of slots that a table does not hold, from the index."""
    return V.missing(spark, _covered(spark, sf))


def q_published_tables(spark, sf):
    """K3: what readers see after a run that ended between two tables, and after it was run again."""
    raw = raw_of(spark, sf)
    store, half = _store(raw), _tip(raw) // 2
    store.one_publish = True
    M.write(raw.where(F.col("slot") < half), store)
    later = raw.where(F.col("slot") >= half - 3)
    U.begin(later, store)
    K.write_all(later, replace(store, tables=DEV_TABLES))   # the other two are not reached
    seen = fresh_path(spark, "seen")
    M.stored_counts(spark, store, U.published(spark, store)).write.parquet(seen)
    M.write(later, store)
    after = M.stored_counts(spark, store, U.published(spark, store))
    return (spark.read.parquet(seen).withColumn("state", F.lit("stopped"))
            .unionByName(after.withColumn("state", F.lit("again"))))


def q_dates_over_batches(spark, sf):
    """R2: blocks without a time come first, alone; the batches after them date them."""
    raw = raw_of(spark, sf)
    store, half = _store(raw, DEV_TABLES), _tip(raw) // 2
    store.by_date = True
    timed = F.col("block_time").isNotNull()
    for batch in (~timed, timed & (F.col("slot") >= half), timed & (F.col("slot") < half)):
        K.write_all(raw.where(batch), store)
    return reduce(DataFrame.unionByName, [
        K.read_table(spark, store, t).groupBy("slot", F.date_format(S.DATE_COLUMN, "yyyy-MM-dd").alias("block_date"))
        .agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for t in store.tables])


QUERIES = {
    "raw_blocks": q_raw_blocks,
    "chain_tip": q_chain_tip,
    "scan_table": q_scan_table,
    "scan_format": q_scan_format,
    "block_time_lookup": q_block_time_lookup,
    "table_exists": q_table_exists,
    "typed_rows": q_typed_rows,
    "ensure_tables": q_ensure_tables,
    "append_table": q_append_table,
    "write_all": q_write_all,
    "show_rows": q_show_rows,
    "blocks": q_blocks,
    "transactions": q_transactions,
    "tx_status": q_tx_status,
    "token_balances": q_token_balances,
    "tx_rewards": q_tx_rewards,
    "instructions_top": q_instructions_top,
    "instructions_inner": q_instructions_inner,
    "instructions": q_instructions,
    "program_id": q_program_id,
    "resolve_accounts": q_resolve_accounts,
    "rewards": q_rewards,
    "table_selection": q_table_selection,
    "slot_range": q_slot_range,
    "non_empty": q_non_empty,
    "permissive_read": q_permissive_read,
    "dropped_items": q_dropped_items,
    "rejected_rows": q_rejected_rows,
    "max_slot": q_max_slot,
    "last_processed_slot": q_last_processed_slot,
    "order_by_slot": q_order_by_slot,
    "first_blocks": q_first_blocks,
    "json_columns": q_json_columns,
    "json_instructions": q_json_instructions,
    "json_rewards": q_json_rewards,
    "start_position": q_start_position,
    "bounded_backfill": q_bounded_backfill,
    "continuous_ingest": q_continuous_ingest,
    "resume": q_resume,
    "skipped_slots": q_skipped_slots,
    "batch_metrics": q_batch_metrics,
    "fill_block_time": q_fill_block_time,
    "date_partitioning": q_date_partitioning,
    "nullability_report": q_nullability_report,
    "parallel_backfill": q_parallel_backfill,
    "missing_by_table": q_missing_by_table,
    "repair_missing": q_repair_missing,
    "slot_coverage": q_slot_coverage,
    "slot_gaps": q_slot_gaps,
    "published_tables": q_published_tables,
    "dates_over_batches": q_dates_over_batches,
}
