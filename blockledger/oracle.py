"""DuckDB oracle: each registered query computed straight from the flat driver
tables (``orders``, ``lineitem``, ``events``), never by nesting them.

The ledger mapping (see ``sources.ledger``) is restated here relationally:
windows give array positions, joins replace nested lookups.
"""

from __future__ import annotations

from . import schemas as S

_BASE = """
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         b + (b + 5) // 10 AS slot,
         o_orderkey % 2 = 0 OR o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has_meta
  FROM (SELECT *, o_orderkey // 16 AS b FROM orders)
),
ev AS (
  SELECT *, b + (b + 5) // 10 AS slot FROM (SELECT *, event_id // 12 AS b FROM events)
),
blk AS (
  SELECT slot,
         CASE WHEN slot = 0 THEN 0 WHEN slot % 11 = 6 THEN slot - 2 ELSE slot - 1 END AS parent_slot
  FROM (SELECT slot FROM o UNION SELECT slot FROM ev)
),
blocks_t AS (
  SELECT slot, parent_slot,
         CASE WHEN slot % 13 <> 7 THEN 1600000000 + 2 * slot END AS block_time,
         slot - (slot + 5) // 11 AS block_height,
         md5('b' || parent_slot) AS previous_blockhash,
         md5('b' || slot) AS blockhash
  FROM blk
),
li AS (
  SELECT l.*, o.slot, o.has_meta, 'P' || l.l_partkey AS part,
         dense_rank() OVER (PARTITION BY l.l_orderkey ORDER BY 'P' || l.l_partkey) - 1 AS part_pos,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                            l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus,
                            l_tax, l_shipdate) AS item_rank
  FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey
),
keys AS (
  SELECT l_orderkey, list_sort(list_distinct(list(part))) AS keys
  FROM li GROUP BY l_orderkey
),
ins_t AS (
  SELECT li.slot, md5('o' || li.l_orderkey) AS tx_signature,
         (CASE WHEN l_returnflag = 'R'
               THEN row_number() OVER (PARTITION BY li.l_orderkey, l_returnflag = 'R', l_linenumber
                                       ORDER BY item_rank)
               ELSE row_number() OVER (PARTITION BY li.l_orderkey, l_returnflag = 'R'
                                       ORDER BY item_rank) END) - 1 AS instruction_index,
         CASE WHEN l_linenumber = 7 THEN len(k.keys) ELSE li.part_pos END AS program_id_index,
         CASE WHEN l_linenumber <> 7 THEN li.part END AS program_id,
         array_to_string([k.keys[x + 1] FOR x IN [l_suppkey % 8, l_linenumber % 8]
                          IF x < len(k.keys)], ',') AS accounts,
         l_returnflag || l_linestatus AS data,
         l_returnflag = 'R' AS is_inner,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS BIGINT) END AS parent_index
  FROM li JOIN keys k ON li.l_orderkey = k.l_orderkey
),
item_n AS (SELECT l_orderkey, count(*) AS n FROM li GROUP BY l_orderkey),
tx_t AS (
  SELECT o.slot, md5('o' || o.o_orderkey) AS signature,
         CAST(CASE WHEN o.o_orderkey % 50 <> 0 THEN 1 END AS BIGINT) AS num_required_signatures,
         CAST(CASE WHEN o.o_orderkey % 50 <> 0 THEN 0 END AS BIGINT) AS num_readonly_signed_accounts,
         CASE WHEN o.o_orderkey % 50 <> 0 THEN o.o_custkey % 5 END AS num_readonly_unsigned_accounts,
         md5('b' || o.slot) AS recent_blockhash,
         CASE WHEN has_meta THEN o_orderstatus <> 'F' END AS success,
         CASE WHEN has_meta AND o_orderstatus = 'F' THEN 'InstructionError' END AS error,
         CASE WHEN has_meta THEN CAST(floor(o_totalprice) AS BIGINT) END AS fee,
         CASE WHEN has_meta AND o_orderstatus <> 'P'
              THEN CAST(floor(o_totalprice) AS BIGINT) || ',' || o_custkey END AS pre_balances,
         CASE WHEN has_meta AND o_orderstatus <> 'P' THEN '0,' || o_custkey END AS post_balances,
         item_n.n AS n_pre_token_balances,
         item_n.n AS n_post_token_balances,
         CASE WHEN has_meta THEN o_orderpriority || ',' || o_orderstatus END AS log_messages,
         item_n.n AS n_rewards,
         CASE WHEN has_meta THEN o_custkey END AS compute_units_consumed
  FROM o LEFT JOIN item_n ON item_n.l_orderkey = o.o_orderkey
),
tok_t AS (
  SELECT slot, md5('o' || l_orderkey) AS signature, side,
         row_number() OVER (PARTITION BY l_orderkey, side ORDER BY item_rank) - 1 AS position,
         part_pos AS account_index, part AS mint,
         CAST(CAST(floor(l_quantity + plus * l_linenumber) AS BIGINT) AS VARCHAR) AS amount,
         CAST(0 AS BIGINT) AS decimals, CAST(l_quantity + plus * l_linenumber AS DOUBLE) AS ui_amount,
         CAST(CAST(floor(l_quantity + plus * l_linenumber) AS BIGINT) AS VARCHAR) AS ui_amount_string,
         CASE WHEN l_linenumber <> 7 THEN 'S' || l_suppkey END AS owner,
         'T' AS program_id
  FROM li, (VALUES ('pre', 0), ('post', 1)) sides(side, plus)
),
txr_t AS (
  SELECT slot, md5('o' || l_orderkey) AS signature,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY item_rank) - 1 AS position,
         'S' || l_suppkey AS pubkey, CAST(floor(l_extendedprice) AS BIGINT) AS lamports,
         l_partkey AS post_balance, l_returnflag AS reward_type,
         CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS BIGINT) END AS commission
  FROM li
),
rewards_t AS (
  SELECT slot, 'u' || user_id AS pubkey,
         CASE WHEN event_type = 'error' THEN -CAST(floor(value * 100) AS BIGINT)
              ELSE CAST(floor(value * 100) AS BIGINT) END AS lamports,
         event_id AS post_balance,
         CASE WHEN event_type <> 'view' THEN event_type END AS reward_type,
         CASE WHEN event_type = 'purchase'
              THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS commission
  FROM ev
),
tip AS (SELECT max(slot) AS tip_slot FROM blk),
bad_tx AS (
  SELECT md5('o' || o_orderkey) AS signature
  FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY o_orderkey) AS n FROM o)
  WHERE n = 1 AND slot % 31 = 4
),
blocks_f AS (
  SELECT * REPLACE (CASE WHEN slot % 29 <> 3 THEN block_height END AS block_height) FROM blocks_t
),
tx_f AS (
  SELECT * REPLACE (CASE WHEN signature NOT IN (SELECT signature FROM bad_tx) THEN signature END AS signature)
  FROM tx_t
),
ins_f AS (
  SELECT * REPLACE (CASE WHEN tx_signature NOT IN (SELECT signature FROM bad_tx) THEN tx_signature END AS tx_signature)
  FROM ins_t
),
accepted_t AS (
  SELECT 'blocks' AS table_name, slot, block_height IS NOT NULL AS ok FROM blocks_f
  UNION ALL SELECT 'transactions', slot, signature IS NOT NULL FROM tx_f
  UNION ALL SELECT 'instructions', slot, tx_signature IS NOT NULL FROM ins_f
  UNION ALL SELECT 'rewards', slot, TRUE FROM rewards_t
),
counts_t AS (
  SELECT 'blocks' AS table_name, slot FROM blocks_t
  UNION ALL SELECT 'transactions', slot FROM tx_t
  UNION ALL SELECT 'instructions', slot FROM ins_t
  UNION ALL SELECT 'rewards', slot FROM rewards_t
)
"""

FAULTY_CTE = {"blocks": "blocks_f", "transactions": "tx_f", "instructions": "ins_f",
              "rewards": "rewards_t"}

BLOCK_COLS = "slot, parent_slot, block_time, block_height, previous_blockhash, blockhash"
TX_COLS = ("slot, signature, num_required_signatures, num_readonly_signed_accounts, "
           "num_readonly_unsigned_accounts, recent_blockhash, success, error, fee, pre_balances, "
           "post_balances, n_pre_token_balances, n_post_token_balances, log_messages, n_rewards, "
           "compute_units_consumed")
INS_COLS = ("slot, tx_signature, instruction_index, program_id_index, program_id, accounts, data, "
            "is_inner, parent_index")
RW_COLS = "slot, pubkey, lamports, post_balance, reward_type, commission"


def _q(body: str) -> str:
    return f"WITH {_BASE.strip()}\n{body.strip()}"


def _counts(where: str = "", tables=S.TABLE_NAMES) -> str:
    names = ", ".join(f"'{t}'" for t in tables)
    cond = f"AND {where}" if where else ""
    return _q(f"""
SELECT table_name, CAST(count(*) AS BIGINT) AS row_count, min(slot) AS min_slot, max(slot) AS max_slot
FROM counts_t WHERE table_name IN ({names}) {cond}
GROUP BY table_name""")


def _nullability() -> str:
    parts = []
    cols_of = {"blocks": S.BLOCKS, "transactions": S.TRANSACTIONS, "instructions": S.INSTRUCTIONS,
               "rewards": S.REWARDS}
    # The oracle CTEs carry arrays as text / counts; their NULL-ness is the array's.
    rename = {"pre_token_balances": "n_pre_token_balances",
              "post_token_balances": "n_post_token_balances", "rewards": "n_rewards"}
    for t, schema in cols_of.items():
        for f in schema.fields:
            c = rename.get(f.name, f.name) if t == "transactions" else f.name
            viol = "CAST(0 AS BIGINT)" if f.nullable else f"CAST(count(*) - count({c}) AS BIGINT)"
            parts.append(
                f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, "
                f"{str(f.nullable).upper()} AS declared_nullable, "
                f"CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
                f"CAST(count(*) AS BIGINT) AS row_count, {viol} AS violations "
                f"FROM {FAULTY_CTE[t]}")
    return _q("\nUNION ALL\n".join(parts))


_FILL = """
SELECT slot, block_time,
       CAST(CASE WHEN block_time IS NOT NULL THEN block_time
            WHEN ps IS NOT NULL AND ns IS NOT NULL THEN pt + ((nt - pt) * (slot - ps)) // (ns - ps)
            WHEN ps IS NOT NULL THEN pt ELSE nt END AS BIGINT) AS block_time_filled,
       block_time IS NULL AS block_time_is_filled
FROM (
  SELECT slot, block_time,
    last_value(CASE WHEN block_time IS NOT NULL THEN slot END IGNORE NULLS)
      OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ps,
    last_value(block_time IGNORE NULLS)
      OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pt,
    first_value(CASE WHEN block_time IS NOT NULL THEN slot END IGNORE NULLS)
      OVER (ORDER BY slot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ns,
    first_value(block_time IGNORE NULLS)
      OVER (ORDER BY slot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nt
  FROM blocks_t
) f"""

_JSON_TX = """
SELECT o.slot, md5('o' || o.o_orderkey) AS signature,
       t.num_required_signatures, t.num_readonly_signed_accounts, t.num_readonly_unsigned_accounts,
       t.recent_blockhash, t.success, t.error, t.fee,
       CASE WHEN has_meta AND o_orderstatus <> 'P'
            THEN CAST(to_json([CAST(floor(o_totalprice) AS BIGINT), o_custkey]) AS VARCHAR) END AS pre_balances,
       CASE WHEN has_meta AND o_orderstatus <> 'P'
            THEN CAST(to_json([CAST(0 AS BIGINT), o_custkey]) AS VARCHAR) END AS post_balances,
       CASE WHEN has_meta THEN coalesce(tj.pre, 'null') END AS pre_token_balances,
       CASE WHEN has_meta THEN coalesce(tj.post, 'null') END AS post_token_balances,
       CASE WHEN has_meta THEN CAST(to_json([o_orderpriority, o_orderstatus]) AS VARCHAR) END AS log_messages,
       CASE WHEN has_meta THEN coalesce(rj.j, 'null') END AS rewards,
       t.compute_units_consumed
FROM o JOIN tx_t t ON t.signature = md5('o' || o.o_orderkey)
LEFT JOIN (
  SELECT signature, max(j) FILTER (side = 'pre') AS pre, max(j) FILTER (side = 'post') AS post FROM (
    SELECT signature, side, CAST(to_json(list({'account_index': account_index, 'mint': mint, 'amount': amount,
           'decimals': decimals, 'ui_amount': ui_amount, 'ui_amount_string': ui_amount_string,
           'owner': owner, 'program_id': program_id} ORDER BY position)) AS VARCHAR) AS j
    FROM tok_t GROUP BY signature, side) GROUP BY signature) tj ON tj.signature = t.signature
LEFT JOIN (
  SELECT signature, CAST(to_json(list({'slot': slot, 'pubkey': pubkey, 'lamports': lamports,
         'post_balance': post_balance, 'reward_type': coalesce(reward_type, 'None'),
         'commission': commission} ORDER BY position)) AS VARCHAR) AS j
  FROM txr_t GROUP BY signature) rj ON rj.signature = t.signature"""


ORACLE = {
    "raw_blocks": _q(f"""
SELECT b.slot, b.parent_slot, b.block_time, b.block_height, b.previous_blockhash, b.blockhash,
       (SELECT CAST(count(*) AS BIGINT) FROM tx_t t WHERE t.slot = b.slot) AS n_transactions,
       (SELECT CAST(count(*) AS BIGINT) FROM rewards_t r WHERE r.slot = b.slot) AS n_rewards
FROM blocks_t b"""),
    "chain_tip": _q("SELECT tip_slot FROM tip"),
    "scan_table": _q(f"SELECT {BLOCK_COLS} FROM blocks_t"),
    "scan_format": _q(f"SELECT {BLOCK_COLS} FROM blocks_t"),
    "block_time_lookup": _q("""
SELECT g.slot, b.block_time
FROM (SELECT range AS slot FROM range(0, (SELECT tip_slot FROM tip) + 1)) g
LEFT JOIN blocks_t b ON b.slot = g.slot"""),
    "table_exists": _q("""
SELECT 'blocks' AS table_name, TRUE AS table_exists, (SELECT CAST(count(*) AS BIGINT) FROM blocks_t) AS row_count
UNION ALL SELECT 'transactions', TRUE, (SELECT CAST(count(*) AS BIGINT) FROM tx_t)
UNION ALL SELECT 'instructions', FALSE, CAST(NULL AS BIGINT)
UNION ALL SELECT 'rewards', FALSE, CAST(NULL AS BIGINT)"""),
    "typed_rows": _q(f"SELECT {RW_COLS} FROM rewards_t"),
    "ensure_tables": _q("""
SELECT table_name, CAST(CASE table_name WHEN 'blocks' THEN 7 WHEN 'transactions' THEN 17
                        WHEN 'instructions' THEN 10 ELSE 7 END AS BIGINT) AS column_count,
       CAST(count(*) AS BIGINT) AS row_count
FROM counts_t GROUP BY table_name"""),
    "append_table": _q(f"SELECT {TX_COLS} FROM tx_f WHERE signature IS NOT NULL"),
    "write_all": _counts(),
    "blocks": _q(f"SELECT {BLOCK_COLS} FROM blocks_t"),
    "transactions": _q(f"SELECT {TX_COLS} FROM tx_t"),
    "tx_status": _q("SELECT slot, signature, success, error FROM tx_t"),
    "token_balances": _q("""
SELECT slot, signature, side, position, account_index, mint, amount, decimals, ui_amount,
       ui_amount_string, owner, program_id FROM tok_t"""),
    "tx_rewards": _q("""
SELECT slot, signature, position, pubkey, lamports, post_balance, reward_type, commission
FROM txr_t"""),
    "instructions_top": _q(f"SELECT {INS_COLS} FROM ins_t WHERE NOT is_inner"),
    "instructions_inner": _q(f"SELECT {INS_COLS} FROM ins_t WHERE is_inner"),
    "instructions": _q(f"SELECT {INS_COLS} FROM ins_t"),
    "program_id": _q("""
SELECT slot, tx_signature, is_inner, parent_index, instruction_index, program_id_index, program_id
FROM ins_t"""),
    "resolve_accounts": _q("""
SELECT slot, tx_signature, is_inner, parent_index, instruction_index,
       CAST(u.p - 1 AS BIGINT) AS account_position, u.a AS account
FROM ins_t, LATERAL (SELECT unnest(string_split(accounts, ',')) AS a,
                            generate_subscripts(string_split(accounts, ','), 1) AS p) u
WHERE accounts <> ''"""),
    "rewards": _q(f"SELECT {RW_COLS} FROM rewards_t"),
    "table_selection": _counts(tables=("blocks", "transactions")),
    "show_rows": _q(f"SELECT {BLOCK_COLS} FROM blocks_t ORDER BY slot LIMIT 10"),
    "slot_range": _q(f"""
SELECT {BLOCK_COLS} FROM blocks_t, tip WHERE slot BETWEEN tip_slot // 4 AND tip_slot // 2 AND slot < tip_slot"""),
    "non_empty": _q("""
SELECT slot, table_name, CAST(count(*) AS BIGINT) AS row_count FROM counts_t GROUP BY slot, table_name"""),
    "permissive_read": _q(f"SELECT {BLOCK_COLS} FROM blocks_t WHERE slot % 37 <> 5"),
    "dropped_items": _q("""
SELECT table_name, slot, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(v) AS BIGINT) AS total FROM (
  SELECT 'transactions' AS table_name, slot, signature, fee AS v FROM tx_t
  UNION ALL
  SELECT 'instructions', slot, NULL, program_id_index FROM (
    SELECT *, count(*) FILTER (WHERE slot % 5 = 2 AND (data = 'NF' OR data = 'RF' AND program_id_index = 3))
              OVER (PARTITION BY tx_signature ORDER BY is_inner, parent_index, instruction_index
                    ROWS UNBOUNDED PRECEDING) AS n_bad
    FROM ins_t) WHERE n_bad = 0
  UNION ALL
  SELECT 'rewards', slot, NULL, lamports FROM rewards_t WHERE slot % 5 <> 2 OR post_balance % 10 <> 3
  UNION ALL
  SELECT 'token_balances', slot, signature, account_index FROM tok_t WHERE slot % 5 <> 2 OR account_index <> 4
  UNION ALL
  SELECT 'tx_rewards', slot, signature, lamports FROM txr_t WHERE slot % 5 <> 2 OR post_balance % 10 <> 3
)
WHERE signature IS NULL OR signature NOT IN (SELECT signature FROM tx_t WHERE slot % 5 = 2 AND fee % 10 = 7)
GROUP BY table_name, slot"""),
    "rejected_rows": _q("""
SELECT table_name, CAST(count(*) FILTER (ok) AS BIGINT) AS accepted_rows,
       CAST(count(*) FILTER (NOT ok) AS BIGINT) AS rejected_rows
FROM accepted_t GROUP BY table_name"""),
    "max_slot": _q("SELECT table_name, max(slot) AS max_slot FROM counts_t GROUP BY table_name"),
    "last_processed_slot": _q("""
SELECT min(m) AS last_processed_slot FROM (
  SELECT max(slot) AS m FROM blocks_t UNION ALL SELECT max(slot) FROM tx_t
  UNION ALL SELECT max(slot) FROM rewards_t)"""),
    "order_by_slot": _q(f"SELECT {BLOCK_COLS} FROM blocks_t ORDER BY slot"),
    "first_blocks": _q(f"SELECT {BLOCK_COLS} FROM blocks_t ORDER BY slot LIMIT 10"),
    "json_columns": _q(_JSON_TX),
    "json_instructions": _q("""
SELECT * REPLACE (CASE WHEN accounts = '' THEN '[]' ELSE '["' || replace(accounts, ',', '","') || '"]' END AS accounts)
FROM ins_t"""),
    "json_rewards": _q("SELECT * REPLACE (coalesce(reward_type, 'None') AS reward_type) FROM rewards_t"),
    "start_position": _q("""
SELECT 'genesis' AS start_mode, CAST(0 AS BIGINT) AS start_slot
UNION ALL SELECT 'latest', (SELECT tip_slot FROM tip)
UNION ALL SELECT 'last_processed', coalesce((
  SELECT min(m) FROM (SELECT max(slot) AS m FROM blocks_t UNION ALL SELECT max(slot) FROM tx_t
                      UNION ALL SELECT max(slot) FROM rewards_t)) + 1, 0)
UNION ALL SELECT '100', CAST(100 AS BIGINT)"""),
    "bounded_backfill": _counts("slot <= (SELECT tip_slot FROM tip) // 2"),
    "continuous_ingest": _counts("slot < (SELECT tip_slot FROM tip)"),
    "batch_metrics": _q("SELECT table_name, CAST(count(*) AS BIGINT) AS input_rows FROM counts_t GROUP BY table_name"),
    "resume": _counts("slot < (SELECT tip_slot FROM tip)"),
    "skipped_slots": _q("""
SELECT g.range AS slot FROM range((SELECT min(slot) FROM blk), (SELECT max(slot) FROM blk) + 1) g
WHERE g.range NOT IN (SELECT slot FROM blk)"""),
    "fill_block_time": _q(_FILL),
    "date_partitioning": _q(f"""
SELECT slot, strftime(DATE '1970-01-01' + CAST(floor(block_time_filled / 86400) AS INTEGER), '%Y-%m-%d')
       AS block_date
FROM ({_FILL}) x"""),
    "nullability_report": _nullability(),
    "parallel_backfill": _counts(),
    "missing_by_table": _q("""
SELECT table_name, slot, CAST(count(*) AS BIGINT) AS expected_rows, CAST(0 AS BIGINT) AS stored_rows
FROM counts_t
WHERE table_name <> 'blocks' AND slot > (SELECT tip_slot FROM tip) // 2
GROUP BY table_name, slot"""),
    "repair_missing": _q("""
SELECT table_name, CAST(count(*) AS BIGINT) AS row_count, min(slot) AS min_slot, max(slot) AS max_slot,
       CAST(0 AS BIGINT) AS slots_missing
FROM accepted_t WHERE ok GROUP BY table_name"""),
    "slot_coverage": _q("""
SELECT table_name, min(slot) AS first_slot, max(slot) AS last_slot FROM (
  SELECT table_name, slot, slot - row_number() OVER (PARTITION BY table_name ORDER BY slot) AS island
  FROM (SELECT DISTINCT table_name, slot FROM counts_t)) GROUP BY table_name, island"""),
    "slot_gaps": _q("""
SELECT table_name, last_slot + 1 AS first_slot, later - 1 AS last_slot FROM (
  SELECT *, lead(first_slot) OVER (PARTITION BY table_name ORDER BY first_slot) AS later FROM (
SELECT table_name, min(slot) AS first_slot, max(slot) AS last_slot FROM (
  SELECT table_name, slot, slot - row_number() OVER (PARTITION BY table_name ORDER BY slot) AS island
  FROM (SELECT DISTINCT table_name, slot FROM counts_t)) GROUP BY table_name, island))
WHERE later IS NOT NULL"""),
    "published_tables": _q("""
SELECT 'stopped' AS state, table_name, CAST(count(*) AS BIGINT) AS row_count, min(slot) AS min_slot, max(slot) AS max_slot
FROM counts_t WHERE slot < (SELECT tip_slot FROM tip) // 2 GROUP BY table_name
UNION ALL
SELECT 'again', table_name, CAST(count(*) AS BIGINT), min(slot), max(slot) FROM counts_t GROUP BY table_name"""),
    "dates_over_batches": _q(f"""
SELECT table_name, slot, block_date, CAST(count(*) AS BIGINT) AS row_count FROM counts_t JOIN (
  SELECT slot, strftime(DATE '1970-01-01' + CAST(floor(block_time_filled / 86400) AS INTEGER), '%Y-%m-%d') AS block_date
  FROM ({_FILL}) x) USING (slot)
WHERE table_name IN ('blocks', 'transactions') GROUP BY ALL"""),
}
