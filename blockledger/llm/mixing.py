"""Mixing sources to target weights by systematic sampling.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and
share the total size by weight; a target stops at ``CAP`` times its source's
size and the excess goes to the others by weight.  The common level is found
from the sources in the order in which they fill up, one row for each source.

Copies: the documents of a source stand in the order of size, largest first, by
classes that halve.  Every document of a class expects the same number of
copies: what is still missing of the target, divided by the words of this class
and all smaller ones (for the first class: target / source size).  The expected
copies are summed up within the source from one random offset; a document is
emitted once for each integer boundary its step crosses.  So a long document
that was or was not taken is made up for by the shorter ones, and the emitted
words end within about a short document of the target.

The classes' expected copies come from counts of (source, size), one small group
for each source; a document's place in its class from counts of (source, size)
and (source, size, id group).  No task holds a source: only the documents of one
source, size and id group are ever ordered together.

Cases: a null or blank text has size 0; a null source is a source of its own;
null ids come first and repeated rows are documents of their own; a source
without words has target 0 and each of its documents no copies; an empty table
gives no rows; other columns are kept by ``mixed`` and not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockledger.llm.common import saved, words_of

CAP = 3
SEED = 17
GROUPS = 1024  # of ids that share a source and a size


def offset(source: Column) -> Column:
    """A number from 0 to 1 drawn for the source: 32 bits of a hash of seed and name."""
    named = F.concat(F.lit(f"{SEED}:"), F.when(source.isNull(), "null").otherwise(F.concat(F.lit("="), source)))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)


def source_key(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("="), source))


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) of each source, from (source, size) rows."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row for each source from here on.
    named = Window.orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("weight", (F.row_number().over(named) - 1) % 3 + 1)
           .withColumn("cap", CAP * F.col("source_size")))
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    all_ = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # What a weight of 1 gets if the sources before this one are full.
    level = ((F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    per = per.withColumn("level", level)
    # It grows until a source is not filled by it, and falls from there on.
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(all_)
    return per.select("source", "source_size",
                      F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


def size_class(size: Column) -> Column:
    """Binary digits of the size, 0 for no words."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def class_steps(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """(k, c, p, r): for each class c of source k the expected copies r of a document and those of all before, p.

    ``sizes`` has (k, size, c, n): documents of each size, at most as many rows
    for a source as it has different sizes.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False)
        u, target, whole = rows["u"].iloc[0], rows["target"].iloc[0], int(rows["source_size"].iloc[0])
        plain = target / whole if whole else 0.0
        left, rest, p, out = target, whole, 0.0, []
        for c, part in rows.groupby("c", sort=False):
            r = min(float(CAP), max(0.0, left / rest)) if rest else plain
            upto = part["n"].cumsum().to_numpy()
            took = np.floor(u + (p + upto * r)) - np.floor(u + (p + (upto - part["n"].to_numpy()) * r))
            out.append((rows["k"].iloc[0], int(c), p, r))
            left -= float((took.astype(np.int64) * part["size"].to_numpy()).sum())
            rest -= int((part["size"] * part["n"]).sum())
            p = p + upto[-1] * r
        return pd.DataFrame(out, columns=["k", "c", "p", "r"])

    return sizes.join(goal, "k").groupBy("k").applyInPandas(run, "k string, c int, p double, r double")


def copies(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(row, size, source_size, target, copies) of each row; ``row`` holds the columns to ``keep``, or all."""
    def keyed(df: DataFrame) -> DataFrame:
        return (df.withColumns({"size": F.size(words_of(F.col("text"))).cast("long"), "tk": F.xxhash64("text")}).drop("text")
                .withColumn("g", F.pmod(F.coalesce(F.col("id"), F.lit(0)), F.lit(GROUPS))))

    slim = docs.select(F.col("text").alias("text"), F.col("source").alias("source"), F.col("doc_id").alias("id"))
    counts = saved(keyed(slim).groupBy("source", "size", "g").agg(F.count("*").alias("n")), "mix-counts")
    key = source_key(F.col("source")).alias("k")
    goal = targets(counts.select("source", F.expr("size * n").alias("size"))).select(
        key, offset(F.col("source")).alias("u"), "source_size", "target")
    goal = saved(goal, "mix-goals")
    sizes = (counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
             .select(key, "size", size_class(F.col("size")).alias("c"), "n"))
    sizes = saved(sizes, "mix-sizes")
    larger = Window.partitionBy("k", "c").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("source", "size").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    start = (counts.select(key, "size", "g", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("same"))
             .join(sizes.select("k", "size", "c", F.coalesce(F.sum("n").over(larger), F.lit(0)).alias("larger")), ["k", "size"])
             .join(class_steps(sizes, goal), ["k", "c"]).join(goal, "k")
             .select("k", "size", "g", (F.col("larger") + F.col("same")).alias("before"), "u", "p", "r", "source_size", "target"))
    start = saved(start, "mix-starts")
    rows = docs.select(F.struct(*(keep or ["*"])).alias("row"), F.col("text").alias("text"), F.col("source").alias("source"),
                       F.col("doc_id").alias("id"))
    rows = keyed(rows).withColumn("k", source_key(F.col("source"))).drop("source").join(start, ["k", "size", "g"])
    rows = rows.withColumn("i", F.col("before") + F.row_number().over(Window.partitionBy("k", "size", "g").orderBy("id", "tk")))
    crossed = F.floor(F.expr("u + (p + i * r)")) - F.floor(F.expr("u + (p + (i - 1) * r)"))
    return rows.select("row", "size", "source_size", "target", F.least(crossed, F.lit(CAP)).cast("long").alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its columns."""
    return (copies(docs).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*"))


#: DuckDB SQL of ``copies`` over documents.
SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
         ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
                   {CAP} * source_size AS cap FROM per),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0)) AS level
  FROM weighed WINDOW f AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), (SELECT max(level) FROM levels WHERE level * weight <= cap) * weight) AS target FROM levels),
sizes AS (SELECT source, size, CASE WHEN size > 0 THEN len(bin(size)) ELSE 0 END AS c, count(*) AS n FROM sized GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER (PARTITION BY source, c ORDER BY size DESC) AS upto FROM sizes),
seeds AS (
  SELECT *, CAST('0x' || substr(md5('{SEED}:' || CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END), 1, 8) AS BIGINT)
              / 4294967296.0::DOUBLE AS u,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS plain,
         (SELECT max(c) FROM sizes) AS top FROM goal),
steps AS (
  SELECT source, u, plain, top AS c, 0.0::DOUBLE AS p, target AS left_, CAST(source_size AS BIGINT) AS rest,
         CASE WHEN source_size > 0 THEN least({CAP}.0::DOUBLE, greatest(0.0::DOUBLE, target / source_size)) ELSE plain END AS r
  FROM seeds
  UNION ALL
  SELECT source, u, plain, c - 1, p2, left2, rest2,
         CASE WHEN rest2 > 0 THEN least({CAP}.0::DOUBLE, greatest(0.0::DOUBLE, left2 / rest2)) ELSE plain END
  FROM (SELECT s.source, s.u, s.plain, s.c,
               s.p + coalesce((SELECT CAST(sum(n) AS BIGINT) FROM sizes z WHERE z.source IS NOT DISTINCT FROM s.source AND z.c = s.c), 0) * s.r AS p2,
               s.left_ - coalesce((SELECT CAST(sum(size * CAST(floor(s.u + (s.p + upto * s.r)) - floor(s.u + (s.p + (upto - n) * s.r)) AS BIGINT)) AS DOUBLE)
                                   FROM cum z WHERE z.source IS NOT DISTINCT FROM s.source AND z.c = s.c), 0) AS left2,
               s.rest - coalesce((SELECT CAST(sum(size * n) AS BIGINT) FROM sizes z WHERE z.source IS NOT DISTINCT FROM s.source AND z.c = s.c), 0) AS rest2
        FROM steps s WHERE s.c > 0)),
ranked AS (
  SELECT doc_id, size, c, source, row_number() OVER (PARTITION BY source, c ORDER BY size DESC, coalesce(doc_id, 0) % {GROUPS}, doc_id NULLS FIRST) AS i
  FROM (SELECT *, CASE WHEN size > 0 THEN len(bin(size)) ELSE 0 END AS c FROM sized))
SELECT k.doc_id, CAST(k.size AS BIGINT) AS size, g.source_size, g.target,
       CAST(k.size * least({CAP}, floor(s.u + (s.p + i * s.r)) - floor(s.u + (s.p + (i - 1) * s.r))) AS BIGINT) AS taken
FROM ranked k JOIN steps s ON s.source IS NOT DISTINCT FROM k.source AND s.c = k.c JOIN goal g ON g.source IS NOT DISTINCT FROM k.source
"""
