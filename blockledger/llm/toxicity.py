"""Toxicity by multiple-instance learning.

A text is a bag of sentences, of which only the text has a label.  Each sentence
has a probability from a logistic unit over its words and their beginnings (so
that inflected forms share what they have learned); a text is toxic if at least
one of its sentences is (noisy-or: one less the product of the sentences'
complements).  Weights are never negative and shrink to zero: words are evidence
for toxicity or none, so no sentence can be talked out of it.  The gradient of the text's log loss goes back through the
noisy-or to the sentences, so training on text labels finds out which sentences
earn the label, and the same weights then point at them (``offending``).

Sentences end at ``.``, ``!``, ``?`` and line ends; words are runs of ASCII
letters (A-Z lower-cased) and of bytes beyond ASCII.

Training is on the driver, on a bounded sample: at most ``TRAIN_DOCS`` labelled
texts in the order of a hash of their ids, whole texts each; words and beginnings
that occur in fewer than ``LEAST_DOCS`` of them are not learned from, so the
model's size is bounded by the sample.  Scoring is in the
tasks, over every sentence of every text.

Cases: a null or empty text has one sentence without words; without labelled
rows, or with one class only, every score is the smoothed share of that class or
near it; repeated labels of an id count once, an id with both labels as the larger;
labels without a text and null labels are not learned from; an id with several
texts is learned from by the text of smallest hash; repeated rows and ties get
equal scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_DOCS = 4000
LEAST_DOCS = 3
BEGINNINGS = range(3, 11)  # bytes
EPOCHS = 40
BATCH = 256
RATE = 0.1
SHRINK = 1e-4  # of the weights, against the mean loss
START = -6.0  # log odds of a sentence before training
DOUBT = 0.002  # share of labels 1 taken to be wrong; a quarter of it of labels 0
WORD_CACHE = 500_000

_KEEP = np.full(256, 32, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[65:91] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)
_KEEP[[10, 13, 33, 46, 63]] = 46  # sentence ends become full stops
_MAP = _KEEP.tobytes()


def tokens(text: bytes) -> list[bytes]:
    """Words in order, with ``.`` at the end of each sentence."""
    return text.translate(_MAP).replace(b".", b" . ").split()


def parts(word: bytes) -> list[bytes]:
    """What a word is learned by: itself, and its beginnings (marked by a full stop, which no word has)."""
    return [word, *(word[:k] + b"." for k in BEGINNINGS if k < len(word))]


class Model(dict):
    """Word to weight, the sum over its parts, remembered up to a bound; a sentence end is nan."""

    def __init__(self, weights: dict[bytes, float], bias: float):
        super().__init__({b".": np.nan})
        self.weights, self.bias = weights, bias

    def __missing__(self, word: bytes) -> float:
        if len(self) >= WORD_CACHE:
            self.clear()
            self[b"."] = np.nan
        get = self.weights.get
        w = self[word] = sum(get(x, 0.0) for x in parts(word))
        return w

    def __reduce__(self):
        return Model, (self.weights, self.bias)

    def sentences(self, text: bytes | None) -> np.ndarray:
        """Probability of each sentence that has a word; one for a text without any."""
        w = tokens(text or b"")
        if not w:
            return sigmoid(np.array([self.bias]))
        x = np.fromiter(map(self.__getitem__, w), np.float64, len(w))
        end = np.isnan(x)
        owner = np.cumsum(end)[~end]
        if not len(owner):
            return sigmoid(np.array([self.bias]))
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        return sigmoid(self.bias + np.add.reduceat(x[~end], first))

    def score(self, text: bytes | None) -> float:
        return float(noisy_or(self.sentences(text)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(p: np.ndarray) -> np.ndarray:
    return -np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())


class Bags:
    """Texts as numbers of words, with each word's sentence; and the features of each word.

    Texts are taken one at a time and kept as numbers, so that what stays is a
    few bytes for each word of the sample.
    """

    def __init__(self, texts: Iterable[list[bytes]]):
        number: dict[bytes, int] = {b".": -1}
        self.words, self.sentence, self.n, seen = [], [], [], []
        for ws in texts:
            a = np.array([number.setdefault(x, len(number) - 1) for x in ws], np.int32)
            end = a < 0
            owner = np.unique(np.cumsum(end)[~end], return_inverse=True)[1].astype(np.int32)
            self.words.append(a[~end])
            self.sentence.append(owner)
            self.n.append(int(owner.max()) + 1 if len(owner) else 1)
            seen.append(np.unique(a[~end]))
        del number[b"."]
        self.count = len(number)
        in_texts = np.bincount(np.concatenate(seen), minlength=self.count) if seen else np.zeros(0, int)
        # A part is counted over the texts of all its words: at least as often as over the texts that have it.
        hashes, owner = [], []
        for k, x in enumerate(number):
            h = [xxhash.xxh3_64_intdigest(p) for p in parts(x)]
            hashes += h
            owner += [k] * len(h)
        owner = np.array(owner, np.int64)
        _, first, feature = np.unique(np.array(hashes, np.uint64), return_index=True, return_inverse=True)
        often = np.bincount(feature, in_texts[owner], len(first)) >= LEAST_DOCS
        keep = often[feature]
        self.owner, self.feature = owner[keep], (np.cumsum(often) - 1)[feature][keep]
        words = list(number)
        at = first[often]  # which of its word's parts a feature is
        place = at - np.searchsorted(owner, owner[at])
        self.names = [parts(words[k])[j] for k, j in zip(owner[at].tolist(), place.tolist())]

    def weights(self, w: np.ndarray) -> np.ndarray:
        """Of each word, from those of the features."""
        return np.bincount(self.owner, w[self.feature], self.count)

    def back(self, g: np.ndarray) -> np.ndarray:
        """The features' gradient from the words'."""
        return np.bincount(self.feature, g[self.owner], len(self.names))

    def of(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(words, their sentences, the sentences' texts, sentences) of some texts."""
        n = np.array([self.n[i] for i in pick])
        first = np.cumsum(n) - n
        return (np.concatenate([self.words[i] for i in pick]),
                np.concatenate([self.sentence[i] + f for i, f in zip(pick, first)]).astype(np.int64),
                np.repeat(np.arange(len(pick)), n), int(n.sum()))


def gradient(word_weights: np.ndarray, bias: float, bags: tuple, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Of the mean log loss of the noisy-or, by the words' weights and by the bias; and the loss."""
    words, sentence, text, n = bags
    p = np.minimum(sigmoid(bias + np.bincount(sentence, word_weights[words], n)), 1 - 1e-12)
    none = np.bincount(text, np.log1p(-p), len(y))  # log probability that no sentence is toxic
    toxic = np.maximum(-np.expm1(none), 1e-12)
    loss = -(y * np.log(toxic) + (1 - y) * none)
    # Of a text's loss by a sentence's log odds: p where the label is 0; else -p times the odds that none is toxic.
    dz = p * (1 - y - y * np.exp(none) / toxic)[text] / len(y)
    return np.bincount(words, dz[sentence], len(word_weights)), float(dz.sum()), float(loss.mean())


def fit(bags: Bags, y: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights of the features and bias, by Adam on batches of texts with weights shrunk and kept from below zero."""
    size = len(bags.names)
    w, b = np.zeros(size), START
    if not len(y):
        return w, 0.0
    soft = np.where(y == 1, 1 - DOUBT, DOUBT / 4)
    r = np.random.default_rng(seed)
    m, v, step, steps = np.zeros(size + 1), np.zeros(size + 1), 0, EPOCHS * -(-len(y) // BATCH)
    for _ in range(EPOCHS):
        order = r.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            pick = order[lo:lo + BATCH]
            gw, gb, _ = gradient(bags.weights(w), b, bags.of(pick), soft[pick])
            g = np.append(bags.back(gw) + SHRINK, gb)
            step += 1
            m = 0.9 * m + 0.1 * g
            v = 0.99 * v + 0.01 * g * g
            d = RATE * (1 - step / (steps + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-5)
            w, b = np.maximum(w - d[:-1], 0), b - d[-1]
    return w, b


def learned(rows: Iterable[tuple[bytes, int]]) -> Model:
    """The model of labelled texts (text, 0 or 1)."""
    labels: list[int] = []

    def words():
        for text, label in rows:
            labels.append(label)
            yield tokens(text)

    bags = Bags(words())
    w, b = fit(bags, np.array(labels, np.float64))
    return Model({x: float(w[k]) for k, x in enumerate(bags.names) if w[k]}, float(b))


def train(docs: DataFrame, labels: DataFrame, wanted, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from at most ``train_docs`` labelled texts whose ids are ``wanted`` (a function of the id column)."""
    ids = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y"))
           .filter("id is not null and y in (0, 1)").filter(wanted(F.col("id")))
           .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(train_docs))
    texts = docs.filter("text is not null").select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    rows = (texts.join(F.broadcast(ids), "id").groupBy("id", "y")
            .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")).select("id", "y", "x.text"))
    return learned((bytes(r.text), r.y) for r in rows.orderBy("id").toLocalIterator())


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, n_sentences, worst, worst_score): the noisy-or of each row's sentences, and the likeliest one."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = known.value
        for b in batches:
            p = [m.sentences(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([float(noisy_or(x)) for x in p], pa.float64()),
                 pa.array([len(x) for x in p], pa.int32()), pa.array([int(x.argmax()) for x in p], pa.int32()),
                 pa.array([float(x.max()) for x in p], pa.float64())],
                ["doc_id", "score", "n_sentences", "worst", "worst_score"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double, n_sentences int, worst int, worst_score double")


def offending(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """(doc_id, sentence, start, length, score, text) of every sentence of at least this probability.

    ``start`` and ``length`` are bytes of the UTF-8 text.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = known.value
        for b in batches:
            rows = [(i, *x) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text")) for x in found(m, t.as_py() or b"")]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(
                (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.string()))],
                ["doc_id", "sentence", "start", "length", "score", "text"])

    def found(m, text):
        plain, at, k = text.translate(_MAP), 0, 0
        for part in plain.split(b"."):
            if part.split():
                p = m.score(part)
                if p >= least:
                    yield k, at, len(part), p, text[at:at + len(part)].decode(errors="replace")
                k += 1
            at += len(part) + 1

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(run, "doc_id long, sentence int, start long, length long, score double, text string")
