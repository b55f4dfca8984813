"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockledger.llm.common import discard, saved


def _least(directed: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its partners, one row for each u."""
    return directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots: the smallest node it reaches.

    Large and small stars in turn (Kiveris et al. 2014) until every node hangs
    on one root; each round is written to the shared folder, so that Spark
    knows its size and joins small graphs without a shuffle.  Hot nodes meet in
    grouped minima, which combine before the shuffle, and in joins that Spark
    can split.
    """
    e = saved(edges.filter("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct(),
              "components")
    while not _is_flat(e):
        both = e.unionByName(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        # Large star: larger partners of u hang under the smallest of u and its partners.
        large = both.filter("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large, "components-large")
        # Small star: so do u itself, by one row, and its other smaller partners.
        least = _least(large)
        others = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, saved(least.withColumnRenamed("m", "v").unionByName(others).distinct(), "components")
        discard(before, large)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _is_flat(e: DataFrame) -> bool:
    """Whether no node hangs on two others, or on one that hangs itself."""
    return (e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
            and e.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").isEmpty())
