"""Ledger-shaped input built by Spark from the driver's flat tables.

``orders`` become transactions, ``lineitem`` rows become instructions, token
balances and transaction rewards, and ``events`` become block rewards.  The
result has the RAW_BLOCK schema (one row per slot), the shape a block source
lands, so every flatten operator downstream runs exactly as on landed blocks.

``land_parquet`` / ``land_json`` write that nested form once under the shared
folder, range-partitioned and sorted by slot, so later scans prune row groups
by slot min/max and read only the nested fields they use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import fresh_path, session_settings

# Fixed values of the fixture mapping (orders/lineitem/events -> ledger).
ORDERS_PER_SLOT = 16          # block number of an order = o_orderkey div 16
BLOCKS_PER_SKIP = 10          # slot = block + (block + 5) div 10: every row keeps a block, and
SKIP_MOD = 11                 # slots with slot % 11 = 5 have none (skipped)
SKIP_REM = 5
PARENT_GAP_REM = 6            # slot % 11 = 6 -> parent is slot - 2
NO_TIME_MOD = 13              # slot % 13 = 7 -> block_time missing
NO_TIME_REM = 7
GENESIS_TIME = 1_600_000_000  # block_time = 1600000000 + 2 * slot
SECONDS_PER_SLOT = 2
NO_HEADER_MOD = 50            # o_orderkey % 50 = 0 -> no message header
PAST_END_LINE = 7             # l_linenumber = 7 -> program index one past the static keys
INNER_FLAG = "R"              # l_returnflag = 'R' -> inner instruction
NO_OWNER_LINE = 7             # l_linenumber = 7 -> owner missing
# No meta: orders without items and with an odd key (even ones have empty lists).
NO_COMMISSION_FLAG = "N"      # l_returnflag = 'N' -> commission missing
EVENTS_PER_SLOT = 12          # block number of a reward = event_id div 12
FAILED_STATUS = "F"           # o_orderstatus = 'F' -> err 'InstructionError'
NO_BALANCE_STATUS = "P"       # o_orderstatus = 'P' -> empty balances
ERROR_TEXT = "InstructionError"
TOKEN_PROGRAM = "T"
# Slots of a landed file at most (about 40 MB of JSON, which is compressed and so read by one task).
SLOTS_PER_FILE = 1024

# Total order of the items of one order (fixes every array position).
ITEM_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
              "l_tax", "l_shipdate")


def _txt(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def slot_of(key: Column, per_block: int) -> Column:
    """Slot of a row: its block number, moved past the slots that have no block."""
    block = F.floor(key / per_block).cast("long")
    return (block + F.floor((block + SKIP_REM) / BLOCKS_PER_SKIP)).cast("long")


def block_header(slot: Column) -> list[Column]:
    parent = (F.when(slot == 0, F.lit(0))
              .when(slot % SKIP_MOD == PARENT_GAP_REM, slot - 2)
              .otherwise(slot - 1)).cast("long")
    return [
        slot.alias("slot"),
        parent.alias("parent_slot"),
        F.when(slot % NO_TIME_MOD != NO_TIME_REM,
               F.lit(GENESIS_TIME) + SECONDS_PER_SLOT * slot).cast("long").alias("block_time"),
        (slot - F.floor((slot + SKIP_REM) / SKIP_MOD)).cast("long").alias("block_height"),
        F.md5(_txt("b", parent)).alias("previous_blockhash"),
        F.md5(_txt("b", slot)).alias("blockhash"),
    ]


def _parts(items: Column) -> Column:
    """Sorted distinct parts of an order (its full account-key list)."""
    return F.array_sort(F.array_distinct(F.transform(items, lambda i: i["part"])))


def _item(i) -> Column:
    """An item with the values that follow from it alone, ready to be put into a transaction."""
    def amount(after: bool):
        # The balance after the transaction is the one before plus the line number.
        a = i["l_quantity"] + i["l_linenumber"] if after else i["l_quantity"]
        text = F.floor(a).cast("string")
        return F.struct(text.alias("amount"), F.lit(0).cast("long").alias("decimals"),
                        a.cast("double").alias("ui_amount"), text.alias("ui_amount_string"))

    return F.when(i.isNotNull(), F.struct(
        *[i[c].alias(c) for c in (*ITEM_ORDER, "part")],
        F.array((i["l_suppkey"] % 8).cast("long"), (i["l_linenumber"] % 8).cast("long")).alias("accounts"),
        F.concat(i["l_returnflag"], i["l_linestatus"]).alias("data"),
        amount(False).alias("before"), amount(True).alias("after"),
        F.when(i["l_linenumber"] != NO_OWNER_LINE, _txt("S", i["l_suppkey"])).alias("owner"),
        F.struct(_txt("S", i["l_suppkey"]).alias("pubkey"),
                 F.floor(i["l_extendedprice"]).cast("long").alias("lamports"),
                 i["l_partkey"].cast("long").alias("post_balance"),
                 i["l_returnflag"].alias("reward_type"),
                 F.when(i["l_returnflag"] != NO_COMMISSION_FLAG,
                        i["l_linenumber"].cast("long")).alias("commission")).alias("reward")))


def _placed(items: Column, parts: Column) -> Column:
    """Per item its instruction, token balances and reward, with its part's place among the account keys."""
    def one(i):
        pos = (F.array_position(parts, i["part"]) - 1).cast("long")

        def token(amount: str):
            return F.struct(pos.alias("account_index"), i["part"].alias("mint"), i[amount].alias("ui_token_amount"),
                            i["owner"].alias("owner"), F.lit(TOKEN_PROGRAM).alias("program_id"))
        return F.struct(
            i["l_linenumber"].alias("line"), (i["l_returnflag"] == INNER_FLAG).alias("inner"),
            F.struct(F.when(i["l_linenumber"] == PAST_END_LINE, F.size(parts).cast("long")).otherwise(pos)
                     .alias("program_id_index"), i["accounts"].alias("accounts"), i["data"].alias("data")).alias("instr"),
            token("before").alias("pre"), token("after").alias("post"), i["reward"].alias("reward"))
    return F.transform(items, one)


def _transaction(order: Column) -> Column:
    """The nested transaction of one order (needs columns ``placed``, ``parts``)."""
    items, parts = F.col("placed"), F.col("parts")      # columns, so nothing below rebuilds them
    top = F.filter(items, lambda i: ~i["inner"])["instr"]
    own = F.filter(items, lambda i: i["inner"])
    inner = F.transform(F.array_sort(F.array_distinct(own["line"])), lambda ln: F.struct(
        ln.cast("long").alias("index"),
        F.filter(items, lambda i: i["inner"] & (i["line"] == ln))["instr"].alias("instructions")))
    key, cust, status = order["o_orderkey"], order["o_custkey"], order["o_orderstatus"]
    price = F.floor(order["o_totalprice"]).cast("long")
    has_balances = status != NO_BALANCE_STATUS
    empty_longs = F.array().cast("array<bigint>")
    header = F.when(key % NO_HEADER_MOD != 0, F.struct(
        F.lit(1).cast("long").alias("num_required_signatures"),
        F.lit(0).cast("long").alias("num_readonly_signed_accounts"),
        (cust % 5).cast("long").alias("num_readonly_unsigned_accounts")))
    message = F.struct(
        header.alias("header"),
        parts.alias("account_keys"),
        F.md5(_txt("b", F.col("slot"))).alias("recent_blockhash"),
        top.alias("instructions"))
    meta = F.when((F.size(items) > 0) | (key % 2 == 0), F.struct(
        F.when(status == FAILED_STATUS, F.lit(ERROR_TEXT)).alias("err"),
        price.alias("fee"),
        F.when(has_balances, F.array(price, cust)).otherwise(empty_longs).alias("pre_balances"),
        F.when(has_balances, F.array(F.lit(0).cast("long"), cust))
         .otherwise(empty_longs).alias("post_balances"),
        items["pre"].alias("pre_token_balances"),
        items["post"].alias("post_token_balances"),
        F.array(order["o_orderpriority"], status).alias("log_messages"),
        items["reward"].alias("rewards"),
        cust.alias("compute_units_consumed"),
        inner.alias("inner_instructions")))
    return F.struct(
        F.struct(F.array(F.md5(_txt("o", key))).alias("signatures"),
                 message.alias("message")).alias("transaction"),
        meta.alias("meta"),
        F.lit(None).cast("boolean").alias(S.UNREADABLE))


def nest_ledger(spark: SparkSession, sf_dir: str, top: int | None = None, parts: int = 1) -> DataFrame:
    """RAW_BLOCK rows built from every row of orders, lineitem and events.

    The flat rows are dealt once to ``parts`` equal slot ranges (up to slot ``top``) and
    sorted there; an item's slot follows from its order's key.  All nesting then runs
    inside the ranges, so no nested row is ever shuffled.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", *ITEM_ORDER)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type", "value", "props")

    v = F.floor(F.col("value") * 100).cast("long")
    reward = F.struct(
        _txt("u", F.col("user_id")).alias("pubkey"),
        F.when(F.col("event_type") == "error", -v).otherwise(v).alias("lamports"),
        F.col("event_id").cast("long").alias("post_balance"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("reward_type"),
        F.when(F.col("event_type") == "purchase",
               F.get_json_object("props", "$.k").cast("long")).alias("commission"))
    item = F.struct(*[F.col(c) for c in ITEM_ORDER], _txt("P", F.col("l_partkey")).alias("part"))

    def flat(df: DataFrame, key: str, per_block: int, kind: str, value: Column, grouped: bool = True) -> DataFrame:
        return df.select(slot_of(F.col(key), per_block).alias("slot"), F.lit(not grouped).alias("is_event"),
                         (F.col(key) if grouped else F.lit(None)).cast("long").alias("key"), value.alias(kind))

    rows = (flat(orders, "o_orderkey", ORDERS_PER_SLOT, "o", F.struct(*orders.columns))
            # Items without an order's key are in no transaction.
            .unionByName(flat(lineitem.where("l_orderkey is not null"), "l_orderkey", ORDERS_PER_SLOT, "i", item), True)
            .unionByName(flat(events, "event_id", EVENTS_PER_SLOT, "e", F.struct("event_id", reward.alias("r")), False), True))
    part = F.floor(F.col("slot") * parts / (top + 1)) if top is not None else F.lit(0)
    # Rewards without a slot are a block of their own.
    block = ["_part", "slot", "_apart"]
    one = [*block, "is_event", "key"]
    rows = (rows.withColumn("_part", F.coalesce(part.cast("int"), F.lit(0)))
            .withColumn("_apart", F.col("slot").isNull() & F.col("is_event"))
            # What follows from one item alone is built in rows, not in lists: rows run as compiled code.
            .repartitionById(parts, F.col("_part")).withColumn("i", _item(F.col("i"))).sortWithinPartitions(*one))
    orders_of_block = F.transform("os", lambda o: F.struct(o["o_orderkey"].alias("k"), _transaction(o).alias("tx")))
    by_key = (rows.groupBy(*one)
              .agg(F.collect_list("o").alias("os"), F.array_sort(F.collect_list("i")).alias("items"),
                   F.collect_list("e").alias("er"))
              .where(F.col("is_event") | (F.size("os") > 0))
              .withColumn("parts", _parts(F.col("items")))
              .withColumn("placed", _placed(F.col("items"), F.col("parts")))
              .select(*block, orders_of_block.alias("ktx"), "er"))

    def sorted_list(c: str, value: str) -> Column:
        return F.when(F.size(c) > 0, F.transform(F.array_sort(c), lambda x: x[value]))

    # A block has transactions, rewards or both.
    nested = (by_key.groupBy(*block)
              .agg(F.flatten(F.collect_list("ktx")).alias("ktx"), F.flatten(F.collect_list("er")).alias("er"))
              .where((F.size("ktx") > 0) | (F.size("er") > 0))
              .select(*block_header(F.col("slot")), sorted_list("er", "r").alias("rewards"),
                      sorted_list("ktx", "tx").alias("transactions")))
    return conform_raw(nested)


def last_slot(spark: SparkSession, sf_dir: str) -> int | None:
    """The largest slot of the nested rows, from the flat tables."""
    keys = [(f"{sf_dir}/orders.parquet", "o_orderkey", ORDERS_PER_SLOT),
            (f"{sf_dir}/events.parquet", "event_id", EVENTS_PER_SLOT)]
    tops = [spark.read.parquet(f).agg(F.max(slot_of(F.col(c), n))).first()[0] for f, c, n in keys]
    return max((t for t in tops if t is not None), default=None)


def conform_raw(df: DataFrame) -> DataFrame:
    """Cast to the RAW_BLOCK schema (field names, order and types)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in S.RAW_BLOCK.fields])


def with_faults(raw: DataFrame) -> DataFrame:
    """``raw`` with rows the sink must refuse: blocks of slots 3 mod 29 without a
    height, and the first transaction of slots 4 mod 31 without a signature."""
    slot = F.col("slot")
    unsigned = F.transform("transactions", lambda t, i: F.when(
        i == 0, t.withField("transaction.signatures", F.array().cast("array<string>"))).otherwise(t))
    return conform_raw(
        raw.withColumn("block_height", F.when(slot % 29 != 3, F.col("block_height")))
        .withColumn("transactions", F.when(slot % 31 == 4, unsigned).otherwise(F.col("transactions"))))


def faulty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``with_faults`` over the landed rows; only the blocks that it changes are landed anew.

    So jobs over them read only the nested leaves they need, of the other blocks from the landing itself.
    """
    key, raw, slot = (spark.sparkContext.applicationId, sf_dir, "faults"), ledger_raw(spark, sf_dir), F.col("slot")
    as_landed = F.coalesce((slot % 29 != 3) & (slot % 31 != 4), F.lit(False))
    if key not in _LANDED:
        out = fresh_path(spark, "landed-faults")
        with_faults(raw.where(~as_landed)).write.parquet(out)
        _LANDED[key] = out
    return raw.where(as_landed).unionByName(spark.read.schema(S.RAW_BLOCK).parquet(_LANDED[key]))


def land_broken(spark: SparkSession, sf_dir: str) -> str:
    """The JSON landing with the lines of slots 5 mod 37 cut off after 40 characters."""
    def cut(line: Column) -> Column:
        return F.when(F.col("slot") % 37 == 5, F.substring(line, 1, 40)).otherwise(line)
    return _land_lines(spark, sf_dir, "broken", cut)


# Values made unreadable in the slots 2 mod 5: (pattern in the line's JSON, what takes its place).
BAD_ITEMS = [
    (r'"fee":(\d*7)(?=[,}])', r'"fee":"x$1"'),                                      # fees that end in 7
    (r'"post_balance":(\d*3)(?=[,}])', r'"post_balance":"x$1"'),                    # rewards' balances that end in 3
    (r'"account_index":4,', r'"account_index":"four",'),                            # token balances of account 4
    (r'"program_id_index":\d+,("accounts":\[[^\]]*\],"data":"NF")', r'"program_id_index":"x",$1'),
    (r'"program_id_index":3,("accounts":\[[^\]]*\],"data":"RF")', r'"program_id_index":"x",$1'),
]


def land_bad_items(spark: SparkSession, sf_dir: str) -> str:
    """The JSON landing with single items of the slots 2 mod 5 made unreadable (``BAD_ITEMS``)."""
    def spoil(line: Column) -> Column:
        bad = line
        for pattern, text in BAD_ITEMS:
            bad = F.regexp_replace(bad, pattern, text)
        return F.when(F.col("slot") % 5 == 2, bad).otherwise(line)
    return _land_lines(spark, sf_dir, "bad-items", spoil)


_LANDED: dict[tuple, str] = {}


def land_parquet(spark: SparkSession, sf_dir: str, path: str | None = None) -> str:
    """Write the nested ledger once as Parquet, range-partitioned and sorted by slot."""
    key = (spark.sparkContext.applicationId, sf_dir, "parquet")
    if path is None and key in _LANDED:
        return _LANDED[key]
    out = path or fresh_path(spark, "landed-parquet")
    top = last_slot(spark, sf_dir)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (top or 0) // SLOTS_PER_FILE + 1)
    # Rows come sorted, so groups are built one after another and none is held in a hash map.
    with session_settings(spark, {"spark.sql.execution.useObjectHashAggregateExec": "false"}):
        nest_ledger(spark, sf_dir, top, parts).write.mode("overwrite").parquet(out)
    if path is None:
        _LANDED[key] = out
    return out


def land_json(spark: SparkSession, sf_dir: str, files: int | None = None,
              path: str | None = None) -> str:
    """Write the nested ledger as JSON lines (one block per line), compressed slot-ranged files."""
    key = (spark.sparkContext.applicationId, sf_dir, "json", files)
    if path is None and key in _LANDED:
        return _LANDED[key]
    out = path or fresh_path(spark, "landed-json")
    raw = spark.read.parquet(land_parquet(spark, sf_dir))
    _write_lines(raw.repartitionByRange(files, "slot") if files else raw, out, one_each=bool(files))
    if path is None:
        _LANDED[key] = out
    return out


def _write_lines(raw: DataFrame, out: str, change=lambda line: line, one_each: bool = False) -> None:
    """Blocks as JSON lines; files of at most ``SLOTS_PER_FILE`` lines, as a compressed file is read by one task."""
    lines = (raw.sortWithinPartitions("slot").select("slot", F.to_json(F.struct(*raw.columns)).alias("value"))
             .select(change(F.col("value")).alias("value")))
    lines.write.mode("overwrite").option("maxRecordsPerFile", 0 if one_each else SLOTS_PER_FILE).text(out, compression="gzip")


def _land_lines(spark: SparkSession, sf_dir: str, kind: str, change) -> str:
    """A JSON landing of its own, once, with ``change`` applied to its lines (which see their ``slot``)."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _LANDED:
        out = fresh_path(spark, f"landed-{kind}")
        _write_lines(spark.read.parquet(land_parquet(spark, sf_dir)), out, change)
        _LANDED[key] = out
    return _LANDED[key]


def ledger_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed RAW_BLOCK rows for ``sf_dir`` (landing them on first use)."""
    return spark.read.schema(S.RAW_BLOCK).parquet(land_parquet(spark, sf_dir))
