"""Language mixtures: held-out accuracy on the given documents, mixtures, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockledger.llm import language as L
from blockledger.llm.common import training_row
from blockledger.llm.queries import op2_language_mixture

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return L.train(docs, F.col("lang"), training_row(F.col("doc_id")))


def test_held_out_accuracy(spark):
    got = op2_language_mixture(spark, SMALL)
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    both = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(both) > 200
    assert sum(r.lang == r.lang_pred for r in both) >= 0.97 * len(both)
    assert all(0 <= r.score <= 1 and abs(sum(r.shares) - 1) < 1e-6 for r in both)


def test_mixture_is_found(spark, model):
    names, logp = model
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("n_chars > 3000").collect()
    by = {}
    for r in docs:
        by.setdefault(r.lang, r.text)
    for a in by:
        for b in by:
            if a < b:
                text = by[a][:2800] + " " + by[b][:1200]
                lang, score, found, shares = L.predict(text, names, logp)
                assert set(found) == {a, b} and found[0] == lang == a
                assert abs(shares[0] - 0.7) < 0.1


def test_selection_matches_full_search(model):
    """The bound that skips a language never changes the choice."""
    names, logp = model
    r = np.random.default_rng(0)
    p = np.exp(logp)
    for _ in range(10):
        n, a, b = 600, *r.choice(len(names), 2, replace=False)
        cells = np.concatenate([r.choice(L.CODES, n, p=p[:, a] / p[:, a].sum()), r.choice(L.CODES, n // 3, p=p[:, b] / p[:, b].sum())])
        c, k = np.unique(cells, return_counts=True)
        chosen, w, _ = L.weights(c, k.astype(float), logp)
        assert set(chosen) == {a, b} and w[chosen.index(a)] > w[chosen.index(b)]


def test_und_and_awkward_rows(spark, documents, model):
    names, logp = model
    got = L.identify(documents, names, logp)
    assert got.select("row.*").columns == documents.columns
    for r in got.collect():
        letters = any(ch.isalpha() for ch in r.row.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert r.lang_pred == "und" or r.lang_pred in names
        assert (r.score == 0 and r.languages == []) if not letters else 0 < r.score <= 1
    kept = L.with_a_language(documents)
    assert kept.columns == documents.columns
    assert kept.count() == documents.filter(F.col("text").rlike(r"\p{L}")).count()


def test_nothing_to_learn_from(documents, no_documents):
    names, logp = L.train(no_documents, F.col("lang"), F.lit(True))
    assert names == []
    assert {r.lang_pred for r in L.identify(documents, names, logp).collect()} == {"und"}
    no_label = documents.withColumn("lang", F.lit(None).cast("string"))
    assert L.with_a_language(no_label).count() == documents.filter(F.col("text").rlike(r"\p{L}")).count()
    assert L.with_a_language(no_documents).collect() == []


def test_one_letter_and_pieces(model, monkeypatch):
    names, logp = model
    assert L.predict("a", names, logp)[0] in names
    assert L.predict("1 2 3 ...", names, logp)[0] == "und"
    text = "the quick and the dead " * 400
    whole = L.trigrams(text)
    monkeypatch.setattr(L, "PIECE", 1000)
    cells, counts = L.trigrams(text)
    assert set(whole[0]) <= set(cells) and abs(counts.sum() - whole[1].sum()) < 40
