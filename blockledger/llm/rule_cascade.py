"""Quality rules as a short-circuit cascade, in DataFrame operations only.

A rule is a named condition on the text that rejects it.  ``estimate`` runs
every rule alone over a sample of rows and takes its cost (seconds a row) and
selectivity (share rejected).  A job's fixed time is far above a rule's own, so
each job evaluates its rule ``REPEATS`` times a row, the time of an empty rule
is taken off, and both are medians of ``RUNS`` jobs; ``ordered`` sorts rules by rejection per cost, and
``verdict`` is one CASE expression that evaluates the rules in that order and
stops at the first that rejects.  Any order gives the same set of kept rows:
sample and timing only change how fast.

``signals`` computes the counts of the base rule for every row.  Repeated
windows are found from hashes of five words: the hashes of a text are first
compared as a set, and only a text that has repeats sorts them with their
positions and adds up the words that the repeated windows cover.

Cases: a null text has no words, fails the base rule and is not kept; ids,
repeated rows and ties do not matter; an empty table gives no rows, and where
the sample is empty the rules keep the order they are given in; other columns
are ignored.
"""

from __future__ import annotations

import statistics
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockledger.llm.common import pairwise, words_of

SPAN = 5
SAMPLE_ROWS = 2000  # rows, about, that costs and selectivities are measured on
REPEATS = 20  # evaluations of a rule for each sampled row, in one job
RUNS = 3  # jobs, of which the median counts
LEAST = 1e-9  # seconds a row: the cost of a rule too cheap to measure

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"


# ------------------------------------------------------------------- signals

def _both(x: Column, y: Column) -> Column:
    return F.xxhash64(x, y)


def signals(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words)."""
    df = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    df = df.withColumn("w", words_of(F.col("text")))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    df = df.withColumn("h2", pairwise(F.col("h"), 1, _both)).withColumn("h4", pairwise(F.col("h2"), 2, _both))
    df = df.withColumn("h5", F.zip_with(F.slice("h4", 1, F.greatest(F.size("h") - 4, F.lit(0))),
                                        F.slice("h", 5, F.greatest(F.size("h") - 4, F.lit(0))), _both))
    df = df.withColumn("some", F.size(F.array_distinct("h5")) < F.size("h5"))
    # (hash, position), sorted: equal windows stand next to each other.
    df = df.withColumn("z", F.when(F.col("some"), F.sort_array(F.transform(
        "h5", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    df = df.withColumn("same", pairwise(F.col("z"), 1, lambda a, b: a["h"] == b["h"]))
    no = F.array(F.lit(False))
    df = df.withColumn("twice", F.zip_with(F.concat(no, "same"), F.concat("same", no), lambda a, b: a | b))
    df = df.withColumn("at", F.sort_array(F.filter(
        F.zip_with("z", "twice", lambda a, t: F.when(t, a["i"])), lambda x: x.isNotNull())))
    covered = F.aggregate(pairwise(F.col("at"), 1, lambda a, b: F.least(b - a, F.lit(SPAN))),
                          F.lit(SPAN).cast("long"), lambda s, x: s + x)
    return df.select(
        "doc_id", "text", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("some"), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


# ------------------------------------------------------------------- cascade

def default_rules() -> dict[str, Column]:
    """Conditions that reject, on ``text`` and the columns of ``signals``."""
    letters = F.regexp_replace("text", r"[^\p{L}]+", "")
    return {
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "word_length": ~F.col("word_chars").between(2 * F.col("n_words"), 15 * F.col("n_words")),
        "repeated_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        "capitals": 2 * F.length(F.regexp_replace(letters, r"[^\p{Lu}]+", "")) > F.length(letters),
        "exclamations": 3 * F.size(F.split("text", r"!!(?=\s|$)")) - 3 > F.col("n_words"),
    }


def estimate(sample: DataFrame, rules: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """Seconds a row above those of an empty rule, and share rejected, of each rule alone over the sample."""
    rows = max(1, sample.count())
    many = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def seconds(rule: Column) -> tuple[float, int]:
        began = time.monotonic()
        hit = many.agg(F.count(F.when(rule, 1))).first()[0]
        return time.monotonic() - began, hit

    jobs = {None: F.col("again") < 0} | rules
    took = {name: [] for name in jobs}
    hits = {}
    seconds(jobs[None])  # the first job also fills the cache
    for _ in range(RUNS):  # in turns, so that a slow spell meets all alike
        for name, rule in jobs.items():
            t, hits[name] = seconds(rule)
            took[name].append(t)
    empty = statistics.median(took.pop(None))
    return {name: (max((statistics.median(t) - empty) / (rows * REPEATS), LEAST), hits[name] / (rows * REPEATS))
            for name, t in took.items()}


def ordered(measured: dict[str, tuple[float, float]]) -> list[str]:
    """Most rejection per cost first; ties keep the order given."""
    return sorted(measured, key=lambda k: -measured[k][1] / max(measured[k][0], LEAST))


def verdict(rules: dict[str, Column], order: list[str]) -> Column:
    """Name of the first rule that rejects the row, null if none does."""
    case = F.lit(None).cast("string")
    for name in reversed(order):
        case = F.when(rules[name], F.lit(name)).otherwise(case)
    return case


def judged(docs: DataFrame, rules: dict[str, Column] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``signals`` without the text, plus base_failed, rejected_by and kept of each row.

    The sample decides the order of the rules only, never a verdict.
    """
    rules = rules or default_rules()
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = signals(docs.sample(share, seed=1)).persist()
    try:
        order = ordered(estimate(sample, rules))
    finally:
        sample.unpersist()
    df = signals(docs).withColumn("base_failed", base_failed())
    df = df.withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(verdict(rules, order)))
    # Which of several rules spoke first depends on the order measured, so only the verdict is returned.
    return df.withColumn("kept", F.col("rejected_by").isNull()).drop("text", "rejected_by")


#: DuckDB SQL of the query over documents.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, unnest(range(i, i + 5)) AS at FROM rep) GROUP BY r),
s AS (SELECT doc_id, text, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS letters,
             len(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS capitals,
             len(regexp_extract_all(text || ' ', '!![\x20\x09-\x0D]')) AS shouts
      FROM w LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_dup_lines > 30 * n_lines OR 2 * capitals > letters OR 3 * shouts > n_words) AS kept
FROM b
"""
