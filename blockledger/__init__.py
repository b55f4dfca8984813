"""blockledger: block-ledger ELT on Spark.

Nested block rows (one per slot) are flattened with built-in DataFrame
expressions into four tables -- blocks, transactions, instructions, rewards --
and appended idempotently to slot-bucketed tables, in batch or as a stream.
"""

__version__ = "0.1.0"
