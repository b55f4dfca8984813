"""Data quality: permissive reads, NOT NULL rejects, nullability report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.tolerant import keep_readable_items

REJECT_REASON = "reject_reason"


def read_permissive(spark: SparkSession, path: str, fmt: str = "json",
                    schema: T.StructType = S.RAW_BLOCK) -> tuple[DataFrame, DataFrame]:
    """Read landed blocks, keep good rows, set aside unreadable ones.

    Returns ``(good, corrupt)``.  A line that does not parse, or a value out of
    range for its type (e.g. an integer above 2^63-1), lands in ``corrupt``
    with its text; every other block is kept whole.

    The JSON reader parses only the fields a query reads, so a bad value in a
    field that is never read is not flagged.  ``convert_landed`` reads every
    field once and is the way to split a landing exactly.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(S.CORRUPT_COLUMN, T.StringType())])
    df = (spark.read.schema(with_corrupt)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", S.CORRUPT_COLUMN)
          .format(fmt).load(path))
    good = df.where(F.col(S.CORRUPT_COLUMN).isNull()).drop(S.CORRUPT_COLUMN)
    corrupt = df.where(F.col(S.CORRUPT_COLUMN).isNotNull()).select(
        "slot", F.col(S.CORRUPT_COLUMN).alias("record"))
    return good, corrupt


def _reason(cols: list[str]):
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in cols])


def split_rejected(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a NULL in a NOT NULL column go to ``<table>_rejected``.

    Returns ``(accepted, rejected)``; ``rejected`` carries ``reject_reason``.
    Only the offending rows are refused, never the rest of their slot.
    """
    req = S.required_columns(table)
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in req])
    return df.where(ok), df.where(~ok).withColumn(REJECT_REASON, _reason(req))


def may_reject(table: str) -> Column:
    """Predicate on block rows: true when the block can yield a rejected row.

    Checked on the block rows with pruned nested reads (first signatures
    only), so the rejects of a batch are found without a second pass over
    its exploded rows.  It may over-select; ``split_rejected`` is exact.
    """
    slot_null = F.col("slot").isNull()
    if table == "blocks":
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in S.required_columns(table)])
    if table in ("transactions", "instructions"):
        sigs = F.col("transactions")["transaction"]["signatures"]
        return slot_null | F.exists(sigs, lambda s: F.get(s, F.lit(0)).isNull())
    return slot_null


def reject_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: accepted and rejected row counts, one aggregate per table."""
    parts = []
    for t, df in tables.items():
        req = S.required_columns(t)
        bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in req])
        parts.append(df.agg(
            F.lit(t).alias("table_name"),
            F.count_if(~bad).cast("long").alias("accepted_rows"),
            F.count_if(bad).cast("long").alias("rejected_rows")))
    return reduce(DataFrame.unionByName, parts)


def nullability_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and column, declared nullability vs observed NULL count.

    One pass per table (all columns counted in one aggregate), then unpivoted.
    ``violations`` is the NULL count of a column declared NOT NULL.
    """
    parts = []
    for t, df in tables.items():
        fields = S.TABLES[t].fields
        counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                        *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in fields])
        stack = ", ".join(f"'{f.name}', {str(f.nullable).lower()}, `{f.name}`" for f in fields)
        parts.append(counts.selectExpr(
            f"'{t}' as table_name", "__rows as row_count",
            f"stack({len(fields)}, {stack}) as (column_name, declared_nullable, null_count)"))
    rep = reduce(DataFrame.unionByName, parts)
    return rep.select(
        "table_name", "column_name", "declared_nullable",
        F.col("null_count").cast("long").alias("null_count"),
        F.col("row_count").cast("long").alias("row_count"),
        F.when(F.col("declared_nullable"), F.lit(0).cast("long"))
         .otherwise(F.col("null_count")).cast("long").alias("violations"))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Rows -> the declared table schema (names, order, types) by casts.

    At scale this replaces ``createDataFrame(rows, schema)``; nullability is
    enforced by ``split_rejected`` rather than by failing the whole batch.
    """
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TABLES[table].fields])


def convert_landed(spark: SparkSession, path: str, out: str, fmt: str = "json",
                   keep_partial: bool = True) -> tuple[DataFrame, DataFrame]:
    """E1 as a job: landed JSON -> Parquet, returning (good blocks, rejected lines).

    One pass writes every parsed field plus the corrupt-record text, split
    into ``_ok=true`` / ``_ok=false`` folders; since everything is written,
    every field is parsed and corruption anywhere in a block is caught.  Rows
    are sorted by slot within the files read together, so later scans of slot-ranged
    landings prune by slot; no row is shuffled, and every line is parsed once.

    A line flagged corrupt always appears in the rejected lines (the log).
    With ``keep_partial`` a flagged block that still parsed a slot is kept
    too, without the items that cannot be read (``functions.tolerant``); an
    unreadable value of the block itself is NULL.  Without it the whole block is
    set aside.
    """
    with_corrupt = T.StructType(S.RAW_BLOCK.fields + [T.StructField(S.CORRUPT_COLUMN, T.StringType())])
    df = (spark.read.schema(with_corrupt).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", S.CORRUPT_COLUMN).format(fmt).load(path))
    (keep_readable_items(df).withColumn("_ok", F.col(S.CORRUPT_COLUMN).isNull())
     .sortWithinPartitions("_ok", "slot")
     .write.mode("overwrite").partitionBy("_ok").parquet(out))
    written = spark.read.parquet(out)
    cols = [f.name for f in S.RAW_BLOCK.fields]
    good_rows = F.col("_ok") | (F.lit(keep_partial) & F.col("slot").isNotNull())
    good = written.where(good_rows).select(*cols)
    rejected = written.where(~F.col("_ok")).select("slot", F.col(S.CORRUPT_COLUMN).alias("record"))
    return good, rejected
