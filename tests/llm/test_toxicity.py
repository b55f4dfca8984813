"""Multiple-instance toxicity: noisy-or, gradients, held-out accuracy, sentences found."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from blockledger.llm import queries, toxicity
from conftest import prose

DATA = "/root/testdata/sf0.1"
BAD = ["vexhorrid", "gromnasty", "bluvile"]


def texts(count: int, seed: int) -> list[tuple[bytes, int]]:
    r = random.Random(seed)
    out = []
    for _ in range(count):
        lines = [prose(r, r.randint(3, 15)) for _ in range(r.randint(1, 12))]
        toxic = int(r.random() < 0.3)
        if toxic:
            k = r.randrange(len(lines))
            lines[k] = lines[k] + " " + r.choice(BAD) + r.choice(["", "ish", "er"])
        out.append((". ".join(lines).encode(), toxic))
    return out


@pytest.fixture(scope="module")
def model():
    return toxicity.learned(texts(400, 1))


def test_noisy_or_is_one_less_the_product():
    p = np.array([0.1, 0.5, 0.0, 0.9])
    assert toxicity.noisy_or(p) == pytest.approx(1 - 0.9 * 0.5 * 0.1)
    assert toxicity.noisy_or(np.array([])) == 0


def test_gradient_matches_differences():
    bags = toxicity.Bags([toxicity.tokens(t) for t, _ in texts(12, 4)])
    r = np.random.default_rng(1)
    w, b, y = r.normal(0, 0.4, bags.count), -2.0, np.array([0, 1, 0.3] * 4, float)
    some = bags.of(np.arange(12))
    g, gb, _ = toxicity.gradient(w, b, some, y)
    loss = lambda w, b: toxicity.gradient(w, b, some, y)[2]
    for k in r.choice(bags.count, 15, replace=False):
        step = np.zeros(bags.count)
        step[k] = 1e-5
        assert g[k] == pytest.approx((loss(w + step, b) - loss(w - step, b)) / 2e-5, abs=1e-7)
    assert gb == pytest.approx((loss(w, b + 1e-5) - loss(w, b - 1e-5)) / 2e-5, abs=1e-7)


def test_learns_sentences_from_text_labels(model):
    held = texts(200, 2)
    assert np.mean([(model.score(t) >= 0.5) == y for t, y in held]) > 0.97
    toxic = [t for t, y in held if y]
    found = [[x for s, x in zip(t.split(b". "), model.sentences(t)) if any(b.encode() in s for b in BAD)] for t in toxic]
    assert np.mean([max(x) == max(model.sentences(t)) for t, x in zip(toxic, found)]) > 0.97
    assert model.score(b"quiet words. vexhorridness") > 0.5  # an unseen form of a known beginning


def test_offending_sentences_with_their_places(spark, model):
    text = "Éine calm line.\nso vexhorrid of you! and an end"
    df = spark.createDataFrame([(1, text), (2, "calm"), (3, None), (4, "")], "doc_id long, text string")
    rows = toxicity.offending(df, model).collect()
    assert [(r.doc_id, r.sentence, r.text) for r in rows] == [(1, 1, "so vexhorrid of you")]
    at = rows[0].start
    assert text.encode()[at:at + rows[0].length].decode() == rows[0].text
    best = {r.doc_id: r for r in toxicity.scored(df, model).collect()}
    assert (best[1].n_sentences, best[1].worst) == (3, 1) and best[1].worst_score == pytest.approx(rows[0].score)


def test_awkward_rows(spark, documents, no_documents, model):
    got = toxicity.scored(documents, model).collect()
    assert len(got) == documents.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in {x.doc_id for x in documents.collect() if not (x.text or "").strip()}}
    assert len(empty) == 1
    assert toxicity.scored(no_documents, model).count() == 0 and toxicity.offending(no_documents, model).count() == 0
    long = spark.createDataFrame([(1, "word " * 400_000), (2, "a. " * 300_000), (3, " " * 2_000_000)], "doc_id long, text string")
    assert toxicity.scored(long, model).count() == 3


def test_labels_that_teach_nothing(spark, documents):
    every = lambda c: c.isNotNull()
    rows = [(0, 1, None), (10 ** 9, 1, 1), (None, 1, 1)]
    for labels in (rows, [], [(i, 1, 0) for i in range(9)], [(i, 1, 1) for i in range(9)], [(1, 0, 1), (1, 0, 0), (2, 0, 0), (3, 0, 0)]):
        m = toxicity.train(documents, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), every)
        assert all(0 <= r.score <= 1 for r in toxicity.scored(documents, m).collect())


def test_held_out_accuracy(spark):
    rows = queries.op13_toxic_sentences(spark, DATA).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect() if r.toxic is not None}
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 500
    assert np.mean([p == y for p, y in held]) > 0.95
    assert np.mean([p for p, y in held if y]) > 0.7 and np.mean([p for p, y in held if not y]) < 0.02
