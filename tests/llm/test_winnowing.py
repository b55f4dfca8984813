"""Decontamination against a scan of every window in Python."""

import hashlib
import random

from blockledger.llm import winnowing as W
from conftest import prose
from tests_llm_brute import hits


def tables(spark, seed=3, short=True):
    r = random.Random(seed)
    word = lambda: r.choice("alpha beta gamma delta épsilon zeta 7 eta theta iota kappa".split()) + str(r.randrange(30))
    items = [" ".join(word() for _ in range(n)) for n in (13, 14, 20, 40, 60)]
    if short:
        items += [" ".join(word() for _ in range(n)) for n in (1, 4, 12)]
    items += ["", None, "?! --", items[3]]
    docs = []
    for k in range(60):
        w = [word() for _ in range(r.choice([0, 5, 12, 13, 30, 200, 900]))]
        for _ in range(r.choice([0, 0, 1, 2])):
            v = (items[r.randrange(5)]).split()
            a = r.randrange(len(v))
            piece = v[a:a + r.choice([5, 12, 13, 14, 25, 60])]
            at = r.randrange(len(w) + 1)
            w[at:at] = [x.upper() if r.random() < 0.2 and x.isascii() else x for x in piece]
        docs.append(r.choice([" ", "\n", ", "]).join(w))
    docs += [None, "", "...", items[0], items[2] + "!", docs[5], docs[5]]
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(docs)] + [(None, items[3], "y", 2)],
                              "doc_id long, text string, item string, n_hit int").repartition(3)
    i = spark.createDataFrame([(k if k != 2 else None, t, "z") for k, t in enumerate(items)], "item_id long, text string, key string")
    return d, i


def check(d, i):
    want_items = [("null" if r.item_id is None else str(r.item_id), r.text) for r in i.collect()]
    texts = [(r.doc_id, r.text) for r in d.collect()]
    want = []
    for k, t in texts:
        n, hit, found = hits(t, want_items)
        h = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want.append((k, n, hit, len(found), h, hit > 0 and 20 * hit >= n))
    key = lambda x: (x[0] is None, x)
    got = sorted((tuple(r) for r in W.contamination(d, i).collect()), key=key)
    assert got == sorted(want, key=key)
    return want


def test_all_windows(spark):
    want = check(*tables(spark))
    assert sum(w[5] for w in want) > 10 and sum(not w[5] for w in want) > 10


def test_without_short_items(spark):
    check(*tables(spark, 4, short=False))


def test_empty_tables(spark):
    d, i = tables(spark)
    check(d, i.limit(0))
    assert W.contamination(d.limit(0), i).collect() == []
    assert W.without_benchmark(d.limit(0), i).collect() == []


def test_filter_keeps_clean_rows_and_columns(spark):
    d, i = tables(spark)
    kept = W.without_benchmark(d, i)
    assert kept.columns == d.columns
    bad = {r.text for r in d.collect() if (lambda n, h, _: h and 20 * h >= n)(*hits(r.text, [(0, x.text) for x in i.collect()]))}
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in d.collect() if r.text not in bad)


def test_plan_has_no_python(spark):
    d, i = tables(spark)
    plan = W.contamination(d, i)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_long_texts_in_linear_room(spark):
    """A text of a million words that is one benchmark passage after the other: no row carries its words per hit."""
    r = random.Random(9)
    items = [(k, prose(r, 40)) for k in range(20)] + [(99, "just three words")]
    passages = [t for _, t in items]
    text = " ".join(r.choice(passages) if r.random() < 0.9 else prose(r, 30) for _ in range(5_000))
    docs = spark.createDataFrame([(1, text), (2, "w " * 1_000_000)], "doc_id long, text string")
    got = {x.doc_id: x for x in W.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    n = len(text.split())
    assert got[1].n_words == n > 150_000 and got[1].n_items == 21 and got[1].contaminated and 0.85 * n < got[1].n_hit <= n
    assert got[2].n_words == 1_000_000 and got[2].n_hit == 0
