"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockledger.session import fresh_path, remove_path, shuffles_removed

#: ASCII white space, and words as its complement.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Cuts the lineage at a place every executor can read, and gives later joins
    a relation whose size Spark knows from its files.  Its shuffle files are removed.
    """
    spark = df.sparkSession
    path = fresh_path(spark, f"llm/{name}")
    with shuffles_removed(spark):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``saved`` wrote, once nothing reads it any more."""
    for df in frames:
        remove_path(df.sparkSession, df._saved_at)


def words_of(text: Column) -> Column:
    """Words between ASCII white space; a null or blank text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def training_row(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 0 or 2 after division by 3; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 != 1


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # lower() is faster, and the same where all characters are ASCII.
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def pairwise(a: Column, step: int, f) -> Column:
    """f(a[i], a[i + step]) for every i that has both."""
    n = F.greatest(F.size(a) - step, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(a, step + 1, n), f)


def let(x: Column, f) -> Column:
    """f(x) with ``x`` computed once, however often ``f`` uses it."""
    return F.transform(F.array(x), f)[0]
