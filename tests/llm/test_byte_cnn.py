"""The byte network: gradients, held-out accuracy, whole texts, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockledger.llm import byte_cnn as B
from blockledger.llm.common import training_row
from blockledger.llm.queries import op6_byte_cnn_quality


def auc(scores, y):
    order = np.argsort(np.argsort(scores))
    pos = y == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op6_byte_cnn_quality(spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    s, y = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    assert len(rows) > 1000 and auc(s, y) > 0.95
    assert np.mean([(r.score >= 0.5) == r.predicted for r in rows]) == 1
    assert np.mean(np.array([r.predicted for r in rows]) == y) > 0.9


def test_gradients_match_differences():
    r = np.random.default_rng(1)
    texts = [B.chunked(bytes(r.integers(97, 123, n, np.uint8))) for n in (30, 600, 1500, 0)]
    m = {k: x.astype(np.float64) for k, x in B.start(1).items()}
    m["b"] = r.normal(0, 0.1, B.FILTERS)  # away from the rectifier's kink
    x, owner = np.concatenate(texts), np.repeat(np.arange(4), [len(t) for t in texts])
    y, w = np.array([1, 0, 1, 0]), np.array([1.0, 2.0, 1.0, 3.0])

    def loss():
        f = B.pooled(m, x)
        h = np.stack([np.concatenate([f[owner == k].mean(0), f[owner == k].max(0)]) for k in range(4)])
        z = h @ m["v"] + m["c"][0]
        return ((np.log1p(np.exp(-z)) + (1 - y) * z) * w).sum() / w.sum()

    g = B.gradients(m, x, owner, y, w)
    for name in m:
        flat, want = m[name].reshape(-1), np.asarray(g[name]).reshape(-1)
        for k in np.argsort(-np.abs(want))[:4]:
            old, e = flat[k], 1e-5
            flat[k] = old + e
            up = loss()
            flat[k] = old - e
            down = loss()
            flat[k] = old
            assert (up - down) / (2 * e) == pytest.approx(want[k], rel=1e-2, abs=1e-6)


def test_chunks_cover_every_byte():
    for n in (0, 1, B.HOP, B.CHUNK, B.CHUNK + 1, 5000):
        c = B.chunked(bytes([7]) * n)
        covered = {k * B.HOP + j for k in range(len(c)) for j in range(B.CHUNK)}
        assert covered >= set(range(n)) and (c == 7).sum() >= n


def test_batches_score_alike(monkeypatch):
    m = B.start(2)
    m["v"] = np.linspace(-1, 1, 2 * B.FILTERS).astype(np.float32)
    r = np.random.default_rng(0)
    texts = [None, b"", b"abc"] + [bytes(r.integers(32, 127, n, np.uint8)) for n in (10, 700, 9000, 300_000)] + [b"x"]
    whole = B.scores(m, texts)
    monkeypatch.setattr(B, "AT_ONCE", 3)
    assert np.allclose(B.scores(m, texts), whole, atol=1e-5)
    assert np.allclose([B.scores(m, [t])[0] for t in texts], whole, atol=1e-5)
    assert whole[0] == whole[1]


def test_awkward_rows(spark, documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 1), (None, 1, 0), (3, None, 0), (9999, 0, 0), (40, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    m = B.train(documents, labels, lambda c: F.lit(True))
    got = B.scored(documents, m).collect()
    assert len(got) == documents.count() and all(0 <= r.score <= 1 for r in got)
    assert B.scored(no_documents, m).collect() == []
    none = B.train(documents, labels.limit(0), lambda c: F.lit(True))
    assert {r.score for r in B.scored(documents, none).collect()} == {0.5}


def test_held_out_long_texts(spark):
    """Texts of more than six chunks, held out, are scored as well as short ones."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = B.train(docs, labels, training_row)
    long = docs.filter("octet_length(text) > 3000").join(labels, "doc_id").filter(~training_row(F.col("doc_id")))
    got = B.scored(long, model).join(labels, "doc_id").select("score", "quality").collect()
    assert len(got) > 200 and np.mean([(r.score >= 0.5) == r.quality for r in got]) > 0.93
