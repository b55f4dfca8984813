"""Quality signals against Python, and the cascade's order."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blockledger.llm import rule_cascade as R


def model(text):
    text = text or ""
    w = text.encode().split()
    w = [x.decode() for x in w]
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {i + j for i, x in enumerate(win) if win.count(x) > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def signals(df):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return [tuple(r) for r in R.signals(df).orderBy("doc_id").select(*cols).collect()]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab \n\t#é\u00a0\x1c\U0001F600", max_size=60)), min_size=1, max_size=12))
def test_signals(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert signals(df) == [model(t) for t in texts]


def test_signals_of_repeats(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice("abcd") for _ in range(n)) for n in (5, 6, 9, 30, 200) for _ in range(6)]
    texts += ["a b c d e " * 2, "a " * 40, "\n".join(["same line here"] * 5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert signals(df) == [model(t) for t in texts]


def test_verdicts_do_not_depend_on_the_order(documents):
    rules = R.default_rules()
    df = R.signals(documents)
    names = list(rules)
    for order in (names, names[::-1]):
        df = df.withColumn("by_" + order[0], R.verdict(rules, order).isNull())
    assert df.filter(F.col("by_" + names[0]) != F.col("by_" + names[-1])).count() == 0


def test_first_rule_speaks(spark):
    rules = {"a": F.col("x") > 1, "b": F.col("x") > 0}
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "x int")
    assert [r[0] for r in df.select(R.verdict(rules, ["a", "b"])).collect()] == [None, "b", "a", None]
    assert [r[0] for r in df.select(R.verdict(rules, ["b", "a"])).collect()] == [None, "b", "b", None]


def test_order_by_rejection_per_cost(spark):
    assert R.ordered({"dear": (4.0, 0.8), "cheap": (1.0, 0.4), "idle": (0.1, 0.0)}) == ["cheap", "dear", "idle"]
    got = R.estimate(spark.range(100).withColumnRenamed("id", "x"), {"half": F.col("x") < 50, "none": F.lit(False)})
    assert got["half"][1] == 0.5 and got["none"][1] == 0 and got["half"][0] > 0


def test_costs_are_those_of_the_rules(spark):
    """A rule that does nothing costs next to nothing; one that scans the text costs more than one that compares numbers."""
    sample = R.signals(spark.range(1500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("Some words. "), 100).alias("text"))).persist()
    rules = R.default_rules()
    got = R.estimate(sample, {"idle": F.col("n_words") < 0, "capitals": rules["capitals"], "symbols": rules["symbols"]})
    sample.unpersist()
    assert got["idle"][0] < 0.1 * got["capitals"][0] and got["symbols"][0] < 0.1 * got["capitals"][0]


def test_judged(documents, no_documents):
    got = R.judged(documents)
    assert got.count() == documents.count()
    assert R.judged(no_documents).collect() == []
    rows = {r.doc_id: r for r in got.collect()}
    nulls = [r.doc_id for r in documents.collect() if r.text is None]
    assert all(rows[i].base_failed and not rows[i].kept and rows[i].n_words == 0 for i in nulls)


def test_clean_prose_is_kept_and_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    n = {(r.quality, r.kept): r["count"] for r in R.judged(docs).filter("n_words >= 10").join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.02 * n[1, True]
    assert n.get((0, True), 0) <= 0.3 * n[0, False]


def test_plan_has_no_python(documents):
    plan = R.judged(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
