"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are hashed; ``K`` neighbouring word hashes make a k-gram hash, and of
every ``W`` neighbouring k-grams the smallest hash is kept as a fingerprint.
Texts that share ``K + W - 1`` (= ``WINDOW``) words in a row see the same
k-grams in the same window, so they share its fingerprint: no shared window is
missed.

1. Fingerprints of the items' windows are joined with those of the documents.
2. In the documents that meet one, every k-gram that is an item's fingerprint is
   a hit, and each hit is extended: all windows of 13 words around it are
   compared whole with the items' windows.
3. Words inside occurring windows are counted once each, items listed.

Items with fewer than ``WINDOW`` words are one window each, found by the k-gram
of their own first words (``short`` below) in the same way.

Documents with equal texts are compared once.  The items' tables are broadcast
only where Spark's own size check allows it.

Cases: a null or wordless text has no words, is never contaminated and has the
hash of the empty list; null ids of documents are returned as they are; an item
without an id counts as item ``null``; repeated rows of either table change
nothing but the number of rows returned; empty tables give no hits; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockledger.llm.common import let, lower_ascii, pairwise, saved

WINDOW = 13
K = 8
W = WINDOW - K + 1
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def hashes(text: Column) -> Column:
    """The hash of each word."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _both(x: Column, y: Column) -> Column:
    return F.xxhash64(x, y)


def _least(x: Column, y: Column) -> Column:
    return F.least(x, y)


def kgrams(a: Column) -> Column:
    """The K-gram hash at each of at least K word hashes (K = 8: pairs of pairs of pairs)."""
    return let(pairwise(a, 1, _both), lambda g: let(pairwise(g, 2, _both), lambda h: pairwise(h, 4, _both)))


def minima(g: Column) -> Column:
    """The smallest of each W neighbouring k-grams (W = 6: of 2, of 4, then two of 4 that overlap)."""
    return let(pairwise(g, 1, _least), lambda m: let(pairwise(m, 2, _least), lambda n: pairwise(n, 2, _least)))


def fingerprints(text: Column) -> Column:
    """Distinct fingerprints; null for a text of fewer than WINDOW words."""
    return let(hashes(text), lambda a: F.when(F.size(a) >= WINDOW, F.array_distinct(let(kgrams(a), minima))))


def window_hash(a: Column, at: Column, n) -> Column:
    return F.xxhash64(F.slice(a, at, n))


def windows_at(a: Column, starts: Column, n) -> Column:
    """(start, wh) of the windows of n words at these places: hashes only, so that no row carries a text's words."""
    return F.transform(starts, lambda i: F.struct(i.alias("start"), window_hash(a, i + 1, n).alias("wh")))


def all_windows(a: Column, n) -> Column:
    return windows_at(a, F.sequence(F.lit(0), F.size(a) - n), n)


def item_windows(items: DataFrame) -> DataFrame:
    """(item, n, wh) of each window of n words."""
    a = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                     hashes(F.col("text")).alias("a")).filter(F.size("a") > 0)
    n = F.least(F.size("a"), F.lit(WINDOW))
    return a.select("item", n.alias("n"), F.explode(all_windows(F.col("a"), n)).alias("w")).select("item", "n", "w.wh").distinct()


def occurrences(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, start, n, item): windows of items in the texts; ``key`` is the text's md5."""
    windows = saved(item_windows(items), "winnow-windows")
    prints = saved(items.select(F.explode_outer(fingerprints(F.col("text"))).alias("fp")).filter("fp is not null").distinct(),
                   "winnow-prints")
    text = docs.select(F.col("text").alias("text"), F.xxhash64("text").alias("tk"))

    # explode_outer: a plain explode would compute its argument a second time, in a filter.
    found = text.select("tk", F.explode_outer(fingerprints(F.col("text"))).alias("fp"))
    found = found.join(prints, "fp", "left_semi").select("tk")
    sizes = [r.n for r in windows.filter(F.col("n") < WINDOW).select("n").distinct().collect()]  # at most 12
    if sizes:
        # Short items: the first words of each, as many as the shortest has.
        least = min(sizes)
        own = items.select(hashes(F.col("text")).alias("a")).filter(F.size("a").between(1, WINDOW - 1))
        own = saved(own.select(window_hash(F.col("a"), F.lit(1), F.lit(least)).alias("fp")).distinct(), "winnow-short")
        grams = let(hashes(F.col("text")), lambda a: F.when(F.size(a) >= least, F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size(a) - least + 1), lambda i: window_hash(a, i, F.lit(least))))))
        grams = text.select("tk", F.explode_outer(grams).alias("fp"))
        found = found.unionByName(grams.join(own, "fp", "left_semi").select("tk"))
    met = saved(found.distinct(), "winnow-met")

    near = (text.join(met, "tk", "left_semi").withColumn("key", F.md5(F.col("text").cast("binary")))
            .dropDuplicates(["key"]))
    near = saved(near.select("key", hashes(F.col("text")).alias("a")), "winnow-near")
    grams = let(F.col("a"), lambda a: F.when(F.size(a) >= WINDOW, kgrams(a)))
    at = near.select("key", F.posexplode_outer(grams).alias("p", "fp"))
    # Around each hit: every window that holds its k-gram.
    spots = at.join(prints, "fp", "left_semi").groupBy("key").agg(F.collect_list("p").alias("spots"))
    begins = F.array_distinct(F.flatten(F.transform("spots", lambda p: F.sequence(
        F.greatest(p - (W - 1), F.lit(0)), F.least(p, F.size("a") - WINDOW)))))
    hits = near.join(spots, "key").select("key", F.explode(windows_at(F.col("a"), begins, F.lit(WINDOW))).alias("w"))
    starts = hits.select("key", "w.start", F.lit(WINDOW).alias("n"), "w.wh")
    for n in sorted(sizes):
        short = near.filter(F.size("a") >= n).select("key", F.explode(all_windows(F.col("a"), F.lit(n))).alias("w"))
        starts = starts.unionByName(short.select("key", "w.start", F.lit(n).alias("n"), "w.wh"))
    return starts.distinct().join(windows, ["n", "wh"]).select("key", "start", "n", "item")


def contamination(docs: DataFrame, items: DataFrame, per_hit: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row of ``docs``.

    Contaminated: at least one word in ``per_hit`` is inside an occurring window.
    """
    found = saved(occurrences(docs, items), "winnow-found")
    covered = (found.select("key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("at"))
               .distinct().groupBy("key").agg(F.count("*").alias("n_hit")))
    listed = (found.select("key", "item").distinct().groupBy("key")
              .agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item")).alias("names")))
    per = saved(covered.join(listed, "key").select(
        "key", "n_hit", "n_items", F.sha2(F.array_join("names", ",").cast("binary"), 256).alias("h")), "winnow-texts")
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.size(words(F.col("text"))).cast("long").alias("n_words"),
                       F.md5(F.col("text").cast("binary")).alias("key")).join(per, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                       F.coalesce("h", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
                       ((n_hit > 0) & (per_hit * n_hit >= F.col("n_words"))).alias("contaminated"))


def without_benchmark(docs: DataFrame, items: DataFrame, per_hit: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = saved(occurrences(docs, items), "winnow-found")
    hit = (found.select("key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("at"))
           .distinct().groupBy("key").agg(F.count("*").alias("n_hit")))
    held = docs.select(F.struct("*").alias("row"), F.col("text"), F.md5(F.col("text").cast("binary")).alias("key"))
    n = F.size(words(F.col("text")))
    bad = F.when(F.col("n_hit").isNotNull(), per_hit * F.col("n_hit") >= n).otherwise(False)
    return held.join(saved(hit, "winnow-texts"), "key", "left").filter(~bad).select("row.*")


#: DuckDB SQL of ``contamination`` over documents and benchmark.
SQL = r"""
WITH dw AS (SELECT doc_id, w, len(w) AS n, row_number() OVER () AS r FROM (
              SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS w
              FROM documents)),
iw AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, w, least(len(w), 13) AS m FROM (
         SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
         FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
win AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM (
          SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM iw)),
sizes AS (SELECT DISTINCT m FROM win),
dwin AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS s FROM (
           SELECT r, w, m, unnest(range(1, n - m + 2)) AS i FROM dw, sizes WHERE n >= m)),
occ AS (SELECT DISTINCT d.r, d.i, d.m, win.item FROM dwin d JOIN win USING (m, s)),
hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + m)) AS at FROM occ) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
          FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= n AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
