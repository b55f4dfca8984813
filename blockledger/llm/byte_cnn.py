"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of ``CHUNK`` bytes that cover it whole.
Each byte is embedded; filters ``2 * STEP`` bytes wide, every ``STEP`` bytes, are
max-pooled over each chunk; the chunks' vectors are combined by their mean and
their maximum over the text, and one logistic unit gives the probability of
label 1.

Training is on the driver, on a bounded sample: at most ``TRAIN_DOCS`` labelled
texts in the order of a hash of their ids, every chunk of each (Adam, classes
weighed equally); responses are worked out for a bounded number of chunks at a
time.  Scoring is in the tasks,
over every byte of every text.

Cases: a null text scores as an empty one, an empty one as a chunk of padding;
without labelled rows, or with one class only, every score is 0.5 or near that
class; repeated labels of an id count once, an id with both labels as the
larger, an id with several texts is learned from by the text of smallest hash;
labels without a text and null labels are not learned from; repeated
rows and ties get equal scores; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 4
CHUNK = 512  # bytes, a multiple of STEP
HOP = 480  # bytes from chunk to chunk: 32 are shared
EMBED = 8
FILTERS = 32
TRAIN_DOCS = 4000
EPOCHS = 8
BATCH = 64
RATE = 0.006
AT_ONCE = 512  # chunks scored together


def chunked(raw: bytes) -> np.ndarray:
    """Overlapping chunks that cover ``raw``, padded with zero bytes: (chunks, CHUNK)."""
    n = max(1, -(-(len(raw) - (CHUNK - HOP)) // HOP))
    x = np.zeros((n - 1) * HOP + CHUNK, np.uint8)
    x[:len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.as_strided(x, (n, CHUNK), (HOP, 1))


def start(seed: int = 3) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    embed = r.normal(0, 0.5, (256, EMBED))
    embed[0] = 0
    w = r.normal(0, 1 / np.sqrt(2 * STEP * EMBED), (2 * STEP * EMBED, FILTERS))
    model = {"embed": embed, "w": w, "b": np.zeros(FILTERS), "v": r.normal(0, 0.1, 2 * FILTERS), "c": np.zeros(1)}
    return {k: x.astype(np.float32) for k, x in model.items()}


def responses(m: dict, chunks: np.ndarray) -> np.ndarray:
    """(chunks, positions, filters) before the rectifier."""
    n = len(chunks)
    e = m["embed"][chunks].reshape(n, CHUNK // STEP, STEP * EMBED)
    half = STEP * EMBED
    # A window is two steps of bytes: each step is multiplied once for either half.
    a = e.reshape(-1, half) @ np.concatenate([m["w"][:half], m["w"][half:]], axis=1)
    a = a.reshape(n, CHUNK // STEP, 2 * FILTERS)
    return a[:, :-1, :FILTERS] + a[:, 1:, FILTERS:] + m["b"]


def pooled(m: dict, chunks: np.ndarray) -> np.ndarray:
    return np.maximum(responses(m, chunks).max(axis=1), 0)


def scores(m: dict, texts: list[bytes | None]) -> np.ndarray:
    parts = [chunked(t or b"") for t in texts]
    first = np.cumsum([0] + [len(p) for p in parts])
    feats = np.empty((first[-1], FILTERS), np.float32)
    waiting, have, at = [], 0, 0
    for k, p in enumerate(parts):
        for lo in range(0, len(p), AT_ONCE):
            waiting.append(p[lo:lo + AT_ONCE])
            have += len(waiting[-1])
            if have >= AT_ONCE or k == len(parts) - 1 and lo + AT_ONCE >= len(p):
                x = waiting[0] if len(waiting) == 1 else np.concatenate(waiting)
                for j in range(0, have, AT_ONCE):
                    feats[at + j:at + min(have, j + AT_ONCE)] = pooled(m, x[j:j + AT_ONCE])
                at, waiting, have = at + have, [], 0
    mean = np.add.reduceat(feats, first[:-1], axis=0) / np.diff(first)[:, None]
    most = np.maximum.reduceat(feats, first[:-1], axis=0)
    z = np.concatenate([mean, most], axis=1) @ m["v"] + m["c"][0]
    return 1 / (1 + np.exp(-z.astype(np.float64)))


def gradients(m: dict, chunks: np.ndarray, owner: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Of the weighted log loss; ``owner`` gives each chunk's text, in order."""
    n, docs = len(chunks), len(y)
    at, top = np.empty((n, FILTERS), np.int64), np.empty((n, FILTERS), np.float32)
    for lo in range(0, n, AT_ONCE):
        r = responses(m, chunks[lo:lo + AT_ONCE])
        at[lo:lo + AT_ONCE] = r.argmax(axis=1)
        top[lo:lo + AT_ONCE] = np.take_along_axis(r, at[lo:lo + AT_ONCE][:, None, :], 1)[:, 0]
    f = np.maximum(top, 0)
    first = np.searchsorted(owner, np.arange(docs))
    size = np.bincount(owner, minlength=docs)[:, None]
    mean, most = np.add.reduceat(f, first, axis=0) / size, np.maximum.reduceat(f, first, axis=0)
    h = np.concatenate([mean, most], axis=1)
    p = 1 / (1 + np.exp(-(h @ m["v"] + m["c"][0])))
    dz = ((p - y) * weight / weight.sum()).astype(np.float32)
    dh = dz[:, None] * m["v"]
    # Chunks share bytes, so several can hold the same maximum: they share its gradient.
    is_most = (f == most[owner]).astype(np.float32)
    is_most /= np.add.reduceat(is_most, first, axis=0)[owner]
    df = dh[owner, :FILTERS] / size[owner] + is_most * dh[owner, FILTERS:]
    df = np.where(top > 0, df, 0).astype(np.float32)
    # Only the window at each maximum counts: its bytes, for each chunk and filter.
    place = (at * STEP)[:, :, None] + np.arange(2 * STEP)
    seen = chunks[np.arange(n)[:, None, None], place]  # (chunks, filters, width)
    e = m["embed"][seen].reshape(n, FILTERS, -1)
    dw = np.einsum("nfk,nf->kf", e, df)
    de = (df[:, :, None] * m["w"].T[None]).reshape(-1, EMBED)
    flat = seen.reshape(-1)
    d_embed = np.stack([np.bincount(flat, de[:, k], 256) for k in range(EMBED)], axis=1)
    d_embed[0] = 0
    return {"embed": d_embed, "w": dw, "b": df.sum(axis=0), "v": h.T @ dz, "c": np.array([dz.sum()])}


def fit(texts: list[np.ndarray], y: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Train on chunk matrices and 0/1 labels."""
    m = start(seed)
    if not len(y):
        m["v"][:] = 0
        return m
    r = np.random.default_rng(seed)
    share = np.bincount(y, minlength=2) / len(y)
    weight = np.where(y == 1, 1 / max(share[1], 0.05), 1 / max(share[0], 0.05))
    s1, s2 = ({k: np.zeros_like(x) for k, x in m.items()} for _ in range(2))
    step, steps = 0, EPOCHS * -(-len(y) // BATCH)
    for _ in range(EPOCHS):
        order = r.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            pick = order[lo:lo + BATCH]
            x = np.concatenate([texts[i] for i in pick])
            owner = np.repeat(np.arange(len(pick)), [len(texts[i]) for i in pick])
            g = gradients(m, x, owner, y[pick], weight[pick])
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for k in m:
                s1[k] = 0.9 * s1[k] + 0.1 * g[k]
                s2[k] = 0.99 * s2[k] + 0.01 * g[k] ** 2
                m[k] = (m[k] - rate * (s1[k] / (1 - 0.9 ** step)) / (np.sqrt(s2[k] / (1 - 0.99 ** step)) + 1e-7)
                        ).astype(np.float32)
    return m


def train(docs: DataFrame, labels: DataFrame, wanted, train_docs: int = TRAIN_DOCS) -> dict[str, np.ndarray]:
    """Fit on at most ``train_docs`` labelled texts whose ids are ``wanted`` (a function of the id column)."""
    # A bounded sample: the first ids in the order of a hash.
    ids = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y"))
           .filter("id is not null and y in (0, 1)").filter(wanted(F.col("id")))
           .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(train_docs))

    texts = docs.filter("text is not null").select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    rows = (texts.join(F.broadcast(ids), "id").groupBy("id", "y")
            .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")).select("id", "y", "x.text"))
    got = sorted(rows.collect(), key=lambda r: r.id)
    return fit([chunked(bytes(r.text)) for r in got], np.array([r.y for r in got], int))


def scored(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, score) of each row of ``docs``."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                s = b.slice(lo, 256)
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), pa.array(scores(model, s.column("text").to_pylist()), pa.float64())],
                    ["doc_id", "score"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double")
