"""Slot-bucketed tables and the idempotent multi-table append (K1-K3).

Layout: each table is partitioned by ``slot_bucket = slot div bucket_size``
(identity partitioning on the raw slot makes one tiny file set per slot).
Appends are idempotent per (table, slot): slots already stored are removed by
a ``left_anti`` join restricted to the batch's slot range, so a replayed
batch or a resumed run never stores a slot twice.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pyspark.errors import AnalysisException

from .. import schemas as S
from ..functions.expressions import slot_bucket, unix_date
from ..operators import blocktime as R
from ..operators import flatten as P
from ..operators import progress as G
from ..operators import quality as Q
from ..session import fresh_path, remove_path, session_settings

# Slots per partition of the stored tables.  Production blocks arrive at
# ~2.5 slots/s, so 100k slots is about half a day of ledger per partition.
DEFAULT_BUCKET_SIZE = 100_000


@dataclass
class LedgerStore:
    """Where and how the four tables are stored.

    ``options`` become table properties at create time (e.g. an Iceberg
    table's ``write.format.default``); they are never applied on append.
    ``by_date`` also partitions the tables by the UTC date of their block (R2);
    with ``one_publish`` runs and streams write through ``plans.publish``, so that
    its readers see a batch in all tables or in none.
    """
    namespace: str
    tables: tuple = S.TABLE_NAMES
    fmt: str = "parquet"
    bucket_size: int = DEFAULT_BUCKET_SIZE
    catalog: str | None = None
    options: dict = field(default_factory=dict)
    by_date: bool = False
    one_publish: bool = False

    @property
    def partitions(self) -> list[str]:
        return [S.partition_column()] + ([S.DATE_COLUMN] if self.by_date else [])

    def fqn(self, table: str) -> str:
        base = f"{self.namespace}.{table}"
        return f"{self.catalog}.{base}" if self.catalog else base


def _ddl(schema) -> str:
    cols = []
    for f in schema.fields:
        cols.append(f"`{f.name}` {f.dataType.simpleString()}")
    return ", ".join(cols)


def _properties(store: LedgerStore) -> str:
    if not store.options:
        return ""
    kv = ", ".join(f"'{k}' = '{v}'" for k, v in store.options.items())
    return f" TBLPROPERTIES ({kv})"


def ensure_tables(spark: SparkSession, store: LedgerStore) -> list[str]:
    """K1: create each enabled table if missing, partitioned by slot bucket."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS "
              f"{(store.catalog + '.') if store.catalog else ''}{store.namespace}")
    names = []
    part = S.partition_column()
    date = f", {S.DATE_COLUMN} date" if store.by_date else ""
    for t in store.tables:
        name = store.fqn(t)
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(S.TABLES[t])}, {part} bigint{date}) "
                      f"USING {store.fmt} PARTITIONED BY ({', '.join(store.partitions)}){_properties(store)}")
        names.append(name)
    return names


def read_table(spark: SparkSession, store: LedgerStore, table: str) -> DataFrame:
    """Fresh read of a stored table (refreshed so files written since are seen)."""
    name = store.fqn(table)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def slot_bounds(raw: DataFrame):
    """(min slot, max slot) of a batch: one tiny aggregate over the slot column."""
    r = raw.agg(F.min("slot").alias("lo"), F.max("slot").alias("hi")).first()
    return (r["lo"], r["hi"])


def _unsorted_partitioned_write(spark: SparkSession, writers: int = 16):
    """Write partitioned output without a sort.

    Rows arrive slot-ordered from the landed files, so each task meets its
    buckets one after another; concurrent writers keep that order in the
    files (tight slot min/max) and skip the sort a partitioned write plans.
    Past ``writers`` open files a task falls back to sorting.
    """
    return session_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(writers),
                                    "spark.sql.optimizer.plannedWrite.enabled": "false"})


def replace_partitions(df: DataFrame, name: str) -> None:
    """Dynamic partition overwrite: only the partitions in ``df`` are replaced."""
    spark = df.sparkSession
    with session_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        df.write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def _insert(df: DataFrame, store: LedgerStore, table: str, target: DataFrame) -> None:
    """Append the rows E2 accepts; no writer gets past this check."""
    accepted, _ = Q.split_rejected(df, table)
    out = accepted.withColumn(S.partition_column(), slot_bucket("slot", store.bucket_size))
    out.select(*target.columns).write.insertInto(store.fqn(table))


def insert_accepted(df: DataFrame, store: LedgerStore, table: str) -> None:
    """Append rows of slots that the table does not hold."""
    spark = df.sparkSession
    with _unsorted_partitioned_write(spark):
        _insert(df, store, table, read_table(spark, store, table))
    spark.catalog.refreshTable(store.fqn(table))


# ------------------------------------------------------------- block dates (R2)

def _buckets(spark: SparkSession, store: LedgerStore, table: str) -> list[dict] | None:
    """The partitions of a table as {column: text}, from the catalog; None where it lists none."""
    try:
        rows = spark.sql(f"SHOW PARTITIONS {store.fqn(table)}").collect()
    except AnalysisException:
        return None
    return [dict(kv.split("=", 1) for kv in r[0].split("/")) for r in rows]


def _known_slot(spark: SparkSession, store: LedgerStore, slot: int, below: bool) -> int | None:
    """The stored slot with a block time that is nearest to ``slot``, below or above it.

    Buckets are read from the nearest outwards, twice as many each time, so as a
    rule one bucket's two columns are read.
    """
    part = S.partition_column()
    df = read_table(spark, store, "blocks")
    beyond = (F.col("slot") < slot) if below else (F.col("slot") > slot)
    nearest = (F.max if below else F.min)("slot")
    df = df.where(beyond & F.col("block_time").isNotNull())
    listed = _buckets(spark, store, "blocks")
    if listed is None:
        return df.agg(nearest).first()[0]
    at = slot // store.bucket_size
    near = sorted({int(p[part]) for p in listed if (int(p[part]) <= at if below else int(p[part]) >= at)}, reverse=below)
    step = 1
    while near:
        found = df.where(F.col(part).between(min(near[:step]), max(near[:step]))).agg(nearest).first()[0]
        if found is not None:
            return found
        near, step = near[step:], 2 * step
    return None


def untimed_dates(raw: DataFrame, store: LedgerStore) -> DataFrame | None:
    """(slot, _d): the date of every block without a time, of the batch and of the tables around it; saved.

    The batch's blocks are filled together with the stored ones from the last
    known time below the batch to the first above it.  Only blocks in between
    can get another date by this batch, so batches in any order give the dates of
    one fill over all blocks.  Times of blocks that E2 refuses date nothing but themselves.
    """
    spark = raw.sparkSession
    whole = F.lit(True)
    for c in S.required_columns("blocks"):
        whole = whole & F.col(c).isNotNull()
    line = raw.where("slot is not null").select("slot", F.when(whole, F.col("block_time")).alias("block_time"))
    lo, hi = slot_bounds(raw)
    if lo is None:
        return None
    if "blocks" in store.tables and spark.catalog.tableExists(store.fqn("blocks")):
        first, last = _known_slot(spark, store, lo, True), _known_slot(spark, store, hi, False)
        stored = (read_table(spark, store, "blocks").where(G.slot_range_filter(first, last, None, store.bucket_size))
                  .select("slot", "block_time"))
        line = line.unionByName(stored).groupBy("slot").agg(F.max("block_time").alias("block_time"))
    if line.where("block_time is null").isEmpty():
        return None
    path = fresh_path(spark, "dates")
    (R.fill_block_time(line, store.bucket_size).where("block_time_is_filled")
     .select("slot", unix_date("block_time_filled").alias("_d")).write.parquet(path))
    return spark.read.schema("slot bigint, _d date").parquet(path)


def with_dates(raw: DataFrame, store: LedgerStore, untimed: DataFrame | None = None) -> DataFrame:
    """Block rows with the UTC date of their (filled) block time, for stores ``by_date``.

    Only the dates of blocks without a time are looked up (``untimed_dates``);
    that list is written out, so Spark knows its size.  A batch of timed blocks is not joined.
    """
    if not store.by_date or S.DATE_COLUMN in raw.columns:
        return raw
    date = unix_date("block_time")
    untimed = untimed_dates(raw, store) if untimed is None else untimed
    if untimed is None or raw.where("block_time is null").isEmpty():
        return raw.withColumn(S.DATE_COLUMN, date)
    return raw.join(untimed, "slot", "left").withColumn(S.DATE_COLUMN, F.coalesce(date, "_d")).drop("_d")


def move_dates(store: LedgerStore, untimed: DataFrame) -> bool:
    """Move stored rows whose block has got another date by a later batch; whether there were any.

    Dates change where an untimed block had its neighbours on one side only, or
    none, so this seldom rewrites anything.  ``blocks`` comes last: until it has
    moved, a replay finds the same rows to move.
    """
    spark = untimed.sparkSession
    path = fresh_path(spark, "moves")
    (read_table(spark, store, "blocks").join(untimed, "slot").where(~F.col(S.DATE_COLUMN).eqNullSafe(F.col("_d")))
     .select("slot", "_d", S.partition_column()).write.parquet(path))
    moves = spark.read.parquet(path)
    buckets = [r[0] for r in moves.select(S.partition_column()).distinct().collect()]
    for t in sorted(store.tables, key=lambda t: t == "blocks") if buckets else ():
        target = read_table(spark, store, t)
        stage = fresh_path(spark, f"move-{t}")
        (target.where(F.col(S.partition_column()).isin(buckets)).join(moves.select("slot", "_d"), "slot", "left")
         .withColumn(S.DATE_COLUMN, F.coalesce("_d", S.DATE_COLUMN)).select(*target.columns)
         .write.partitionBy(*store.partitions).parquet(stage))
        replace_buckets(spark, stage, store, t, buckets)
    remove_path(spark, path)
    return bool(buckets)


def replace_buckets(spark: SparkSession, stage: str, store: LedgerStore, table: str, buckets) -> None:
    """Put staged rows in the place of whole slot buckets, and remove the stage.

    A partition (bucket and date) of them that got no row is dropped.
    """
    part = S.partition_column()
    target = read_table(spark, store, table)
    staged = spark.read.schema(target.schema).parquet(stage)
    full = {tuple(r) for r in staged.select(*[F.col(c).cast("string") for c in store.partitions]).distinct().collect()}
    replace_partitions(staged.select(*target.columns), store.fqn(table))
    wanted, gone = set(map(int, buckets)), []
    for p in _buckets(spark, store, table) or ():
        values = tuple(None if p[c].startswith("__HIVE") else p[c] for c in store.partitions)
        if int(p[part]) in wanted and values not in full:
            gone.append("PARTITION (" + ", ".join(f"{c} = null" if v is None else f"{c} = '{v}'"
                                                  for c, v in zip(store.partitions, values)) + ")")
    if gone:
        spark.sql(f"ALTER TABLE {store.fqn(table)} DROP IF EXISTS {', '.join(gone)}")
    spark.catalog.refreshTable(store.fqn(table))
    remove_path(spark, stage)


# ------------------------------------------------------------- what is stored

def batch_status(raw: DataFrame, store: LedgerStore, lo: int, hi: int):
    """Per table and slot bucket: slots of the batch that should have rows, and those that have.

    One job for all tables over slot numbers and counts; None when the tables
    hold nothing in [lo, hi] (a first load).  At most tables * span / bucket
    rows reach the driver.
    """
    have = _stored(raw.sparkSession, store, lo, hi)
    if have.isEmpty():
        return None
    exp = G._long(G.expected_rows(raw), store.tables).where("expected_rows > 0").select("slot", "table_name")
    rows = (exp.join(have.withColumn("there", F.lit(1)), ["slot", "table_name"], "left")
            .groupBy("table_name", slot_bucket("slot", store.bucket_size).alias("bk"))
            .agg(F.count("*").alias("n"), F.count("there").alias("stored")).collect())
    status: dict[str, dict[int, tuple[int, int]]] = {t: {} for t in store.tables}
    for r in rows:
        status[r["table_name"]][r["bk"]] = (r["n"], r["stored"])
    return status


def _stored(spark: SparkSession, store: LedgerStore, lo: int, hi: int, tables=None) -> DataFrame:
    """Distinct (slot, table_name) the tables hold in [lo, hi]; the bucket predicate prunes partitions."""
    b = store.bucket_size
    parts = [read_table(spark, store, t)
             .where(F.col(S.partition_column()).between(lo // b, hi // b))
             .where(F.col("slot").between(lo, hi)).select("slot", F.lit(t).alias("table_name"))
             for t in tables or store.tables]
    return reduce(DataFrame.unionByName, parts).distinct()


def _runs(numbers) -> list[tuple[int, int]]:
    """Sorted numbers as runs (first, last) without gaps."""
    out: list[list[int]] = []
    for n in sorted(numbers):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [tuple(r) for r in out]


def _in_runs(c, runs):
    return reduce(lambda a, b: a | b, [c.between(lo, hi) for lo, hi in runs], F.lit(False))


def skip_stored(df: DataFrame, store: LedgerStore, table: str, status: dict[int, tuple[int, int]],
                lo: int, hi: int) -> DataFrame | None:
    """Rows of ``df`` whose slot the table does not hold yet; None if it holds them all.

    Buckets that are stored whole are left out by a predicate, one range for
    each run of them.  Only buckets stored in part need a slot-level anti-join;
    their stored slots are written out first, so that Spark knows the size of
    that side when it picks the join, and moves the wide rows only if it is big.
    """
    whole = [b for b, (n, there) in status.items() if there == n]
    partial = [b for b, (n, there) in status.items() if 0 < there < n]
    if len(whole) == len(status):
        return None
    bk = slot_bucket("slot", store.bucket_size)
    out = df.where(bk.isNull() | ~_in_runs(bk, _runs(whole))) if whole else df
    if partial:
        spark = df.sparkSession
        path = fresh_path(spark, f"stored-{table}")
        (_stored(spark, store, lo, hi, [table]).where(_in_runs(bk, _runs(partial))).select("slot")
         .write.parquet(path))
        out = out.join(spark.read.parquet(path), "slot", "left_anti")
    return out


def _slot_status(df: DataFrame, store: LedgerStore, table: str, lo: int, hi: int) -> dict[int, tuple[int, int]] | None:
    """``batch_status`` of one table's rows: per bucket, their slots and those stored; None on a first load."""
    have = _stored(df.sparkSession, store, lo, hi, [table]).select("slot")
    if have.isEmpty():
        return None
    rows = (df.where("slot is not null").select("slot").distinct()
            .join(have.withColumn("there", F.lit(1)), "slot", "left")
            .groupBy(slot_bucket("slot", store.bucket_size).alias("bk"))
            .agg(F.count("*").alias("n"), F.count("there").alias("stored")).collect())
    return {r["bk"]: (r["n"], r["stored"]) for r in rows}


def append_table(df: DataFrame, store: LedgerStore, table: str,
                 slot_range: tuple | None = None, dedupe: bool = True) -> str:
    """K2: append one table's rows, skipping slots the table already holds.

    Rows that E2 refuses go to ``<table>_rejected``, as in ``write_all``.  A store
    ``by_date`` needs rows that carry ``S.DATE_COLUMN`` (see ``with_dates``).
    Returns the table name; a no-op when the table is not enabled.
    """
    name = store.fqn(table)
    if table not in store.tables:
        return name
    spark = df.sparkSession
    target = read_table(spark, store, table)
    lo, hi = slot_range if slot_range is not None else slot_bounds(df)
    _, bad = Q.split_rejected(df, table)
    if lo is not None:
        src = df
        if dedupe:
            status = _slot_status(df, store, table, lo, hi)
            src = skip_stored(df, store, table, status, lo, hi) if status else df
        if src is not None:
            with _unsorted_partitioned_write(spark):
                _insert(src, store, table, target)
    _write_rejects(bad, store, table)
    return name


def _batch_stats(raw: DataFrame):
    """(rows, distinct slots, min slot, max slot, most items in a block, and per
    table the block rows that may hold rejected rows).

    One aggregate over the block columns and one leaf of each item list.
    """
    return raw.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("slot").alias("d"),
                   F.min("slot").alias("lo"), F.max("slot").alias("hi"),
                   F.max(P.most_items(raw)).alias("most_items"),
                   *[F.count_if(Q.may_reject(t)).alias(f"rej_{t}") for t in S.TABLE_NAMES]
                   ).first()


def dedupe_slots(raw: DataFrame, stats=None) -> DataFrame:
    """Keep one block row per slot: the one with the most transactions, then the
    smallest block hash, then the smallest hash of the whole row.

    One aggregate on the slot column (count vs distinct) decides; when a slot
    does occur twice, only the rows of such slots are shuffled to drop the
    extra copies.  Rows without a slot are no copies of each other.
    """
    st = stats or _batch_stats(raw)
    twice = (raw.where("slot is not null").groupBy("slot").agg(F.count(F.lit(1)).alias("c"))
             .where(F.col("c") > 1).select("slot"))
    if st["n"] == st["d"] or twice.isEmpty():
        return raw
    order = Window.partitionBy("slot").orderBy(
        F.coalesce(F.size(F.col("transactions")["transaction"]["signatures"]), F.lit(-1)).desc(),
        "blockhash", F.xxhash64(*raw.columns))
    path = fresh_path(raw.sparkSession, "landed-twice")
    twice.write.parquet(path)
    twice = raw.sparkSession.read.parquet(path)
    once = raw.join(twice, "slot", "left_anti")
    kept = (raw.join(twice, "slot", "left_semi").withColumn("_copy", F.row_number().over(order))
            .where("_copy = 1").drop("_copy"))
    return once.unionByName(kept)


def rejects_name(store: LedgerStore, table: str) -> str:
    return store.fqn(f"{table}_rejected")


def append_new(df: DataFrame, name: str, ddl: str, fmt: str, part: str | None = None) -> None:
    """Append the rows of ``df`` that table ``name`` does not hold yet.

    Rows are compared by a hash of all their columns, which takes nulls like
    values, so a replay adds nothing.  For side tables, far smaller than the
    data: rejected rows, logs, metrics.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt}"
              + (f" PARTITIONED BY ({part})" if part else ""))
    spark.catalog.refreshTable(name)
    target = spark.table(name)
    rows = df.select(*target.columns)
    h = F.xxhash64(*target.columns)
    path = fresh_path(spark, "append-new")
    rows.withColumn("_h", h).join(target.select(h.alias("_h")).distinct(), "_h", "left_anti").drop("_h") \
        .write.parquet(path)
    spark.read.schema(rows.schema).parquet(path).write.insertInto(name)
    remove_path(spark, path)
    spark.catalog.refreshTable(name)


def _write_rejects(bad: DataFrame, store: LedgerStore, table: str) -> None:
    """E2 in the sink: rows breaking NOT NULL go to ``<table>_rejected``, once each.

    They are written out first, as finding them reads the batch and they are looked at twice.
    """
    spark, part, stage = bad.sparkSession, S.partition_column(), fresh_path(bad.sparkSession, f"rejects-{table}")
    bad = bad.withColumn(part, slot_bucket("slot", store.bucket_size))
    bad.write.parquet(stage)
    staged = spark.read.schema(bad.schema).parquet(stage)
    if not staged.isEmpty():
        append_new(staged, rejects_name(store, table),
                   f"{_ddl(S.TABLES[table])}, {Q.REJECT_REASON} string, {part} bigint", store.fmt, part)
    remove_path(spark, stage)


def _write_table(raw: DataFrame, store: LedgerStore, table: str, lo: int | None, hi: int | None, status,
                 chunk: int | None, may_reject: bool) -> str:
    """One table of a batch: the slots it does not hold yet, and its rejected rows.

    Stored slots are skipped on the block rows, before any explode: one row per
    slot is far cheaper to filter than the rows it expands to.
    """
    src = raw if lo is not None else None
    if status is not None:
        src = skip_stored(raw, store, table, status[table], lo, hi) if status[table] else None
    if src is not None:
        if chunk and table in P.ITEMS:
            src = P.spread_hot_blocks(src, P.ITEMS[table], chunk)
        _insert(P.BUILDERS[table](src), store, table, read_table(raw.sparkSession, store, table))
    if may_reject:
        _write_rejects(Q.split_rejected(P.BUILDERS[table](raw.where(Q.may_reject(table))), table)[1], store, table)
    return store.fqn(table)


def write_all(raw: DataFrame, store: LedgerStore, dedupe: bool = True,
              persist: bool = False, parallel: bool = True,
              hot_chunk: int = P.HOT_BLOCK_ITEMS) -> list[str]:
    """K3: write every enabled table for the slots in ``raw``.

    Each table's plan is a narrow flatten of the block rows.  Over landed
    Parquet every table reads only its own nested leaves, so nothing is
    persisted; pass ``persist=True`` for sources that must be parsed whole
    (JSON), so the fan-out to four tables parses them once.  One small
    aggregate gives the batch's slot range and whether it holds a slot twice,
    one more job what the tables hold of it; a table that holds everything is
    not written at all, so a replay starts no write.

    The tables are independent jobs; with ``parallel`` they are submitted
    together from driver threads so their stages share the executors (resume
    stays correct in any completion order: last processed is the minimum
    over tables).  Without it they are written in table order.

    When the batch stats show a block with more than ``hot_chunk`` transactions
    or rewards, the row tables are built from that block's slices spread over
    tasks (``flatten.spread_hot_blocks``).
    """
    spark = raw.sparkSession
    ensure_tables(spark, store)
    held = []
    if persist:
        raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(raw)
    try:
        st = _batch_stats(raw)
        if not st["n"]:
            return []
        if dedupe and st["n"] != st["d"]:
            raw = dedupe_slots(raw, st).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(raw)
        untimed = untimed_dates(raw, store) if store.by_date and S.DATE_COLUMN not in raw.columns else None
        raw = with_dates(raw, store, untimed)
        status = batch_status(raw, store, st["lo"], st["hi"]) if dedupe and st["lo"] is not None else None
        chunk = hot_chunk if (st["most_items"] or 0) > hot_chunk else None
        # Before the batch's own rows are in, which have their dates: the buckets to rebuild are smaller.
        if untimed is not None and "blocks" in store.tables:
            move_dates(store, untimed)
        args = [(raw, store, t, st["lo"], st["hi"], status, chunk, st[f"rej_{t}"] > 0) for t in store.tables]
        with _unsorted_partitioned_write(spark):
            if parallel and len(args) > 1:
                with ThreadPoolExecutor(max_workers=len(args)) as pool:
                    names = list(pool.map(lambda a: _write_table(*a), args))
            else:
                names = [_write_table(*a) for a in args]
        return names
    finally:
        for h in held:
            h.unpersist()


def stored_max_value(spark: SparkSession, store: LedgerStore, table: str) -> int | None:
    """A1 on a stored table, reading only its highest slot bucket.

    ``slot_bucket`` rises with ``slot``, so the maximum lies in the top bucket;
    the bucket list comes from the catalog's partition listing (no data read),
    then one pruned partition is scanned.  Catalogs without a partition
    listing fall back to a scan of the ``slot`` column.
    """
    df = read_table(spark, store, table)
    part = S.partition_column()
    try:
        top = (spark.sql(f"SHOW PARTITIONS {store.fqn(table)}")
               .select(F.max(F.regexp_extract("partition", rf"{part}=(-?\d+)", 1)
                             .cast("long"))).first()[0])
    except AnalysisException:
        return G.max_slot(df).first()[0]
    if top is None:
        return None
    value = G.max_slot(df.where(F.col(part) == top)).first()[0]
    if value is None:                       # listed but empty partition: scan it all
        value = G.max_slot(df).first()[0]
    return value


def stored_max_slot(spark: SparkSession, store: LedgerStore, table: str) -> DataFrame:
    """A1 on a stored table as a one-row ``max_slot`` frame."""
    return spark.createDataFrame([(stored_max_value(spark, store, table),)], "max_slot bigint")


def stored_last_processed(spark: SparkSession, store: LedgerStore) -> DataFrame:
    """A2 over the stored tables: min of per-table maxima; NULL if one is missing/empty.

    The per-table maxima (one pruned partition each) are computed concurrently.
    """
    def one(t):
        name = store.fqn(t)
        return stored_max_value(spark, store, t) if spark.catalog.tableExists(name) else None
    with ThreadPoolExecutor(max_workers=max(1, len(store.tables))) as pool:
        maxima = list(pool.map(one, store.tables))
    value = None if (not maxima or any(m is None for m in maxima)) else min(maxima)
    return spark.createDataFrame([(value,)], "last_processed_slot bigint")


def compact_buckets(spark: SparkSession, store: LedgerStore, table: str,
                    first_bucket: int, last_bucket: int) -> bool:
    """Rewrite the files of buckets [first, last] of a table, slot-sorted.

    Streams and small batches leave several files per bucket.  The buckets'
    rows are range-partitioned by (slot, bucket) -- so a large bucket is split
    across tasks rather than landing in one -- written to a staging folder
    under the shared folder, then put back with a dynamic partition overwrite
    that replaces only those buckets.  Returns whether there was anything to
    rewrite.
    """
    part = S.partition_column()
    target = read_table(spark, store, table)
    sel = target.where(F.col(part).between(first_bucket, last_bucket))
    if sel.isEmpty():
        return False
    stage = fresh_path(spark, f"compact-{table}")
    (sel.repartitionByRange(part, "slot").sortWithinPartitions(part, "slot")
     .write.mode("overwrite").partitionBy(*store.partitions).parquet(stage))
    replace_partitions(spark.read.parquet(stage).select(*target.columns), store.fqn(table))
    remove_path(spark, stage)
    return True
