"""Language identification as mixture inference.

A text is a mixture of languages: each byte trigram is drawn from language ``l``
with weight ``w_l``.  Trigram tables are counted by Spark over every training
row; for each text expectation-maximisation estimates the weights from the
trigram likelihoods.  The language set grows one language at a time while the
log likelihood rises by more than a penalty of ``PENALTY * ln(trigrams)``.  A
text is tried against a further language only if the bound of the likelihood's
concavity lets it win that much, so most texts need no iteration at all.

Trigrams are read from the whole text, lower-cased, everything but letters
being one space; they are hashed into ``CODES`` cells.

Cases: a null text, or one with no letter, is ``und`` with score 0 and no
languages; without any training row every text is ``und``.  Repeated rows get
equal answers, ties go to the language that sorts first, other columns are
neither read nor changed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CODES = 1 << 16
PENALTY = 3.0
STEPS = 40  # of expectation-maximisation at most
SMOOTH = 0.5
PIECE = 1 << 20  # characters of a text turned into trigrams at a time

_LETTER = regex.compile(r"\p{L}")
_KEEP = np.full(256, 32, np.uint32)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)

FOUND = [("lang_pred", T.StringType()), ("score", T.DoubleType()),
         ("languages", T.ArrayType(T.StringType())), ("shares", T.ArrayType(T.DoubleType()))]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram cells of a text and how often each occurs."""
    cells, counts = [], []
    for lo in range(0, max(1, len(text)), PIECE):
        b = _KEEP[np.frombuffer((" " + text[max(0, lo - 2) if lo else 0:lo + PIECE].lower() + " ").encode(), np.uint8)]
        g = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        g = g[(g & 0xFF00 != 0x2000) | ((g >> 16 != 32) & (g & 255 != 32))]  # a middle space needs two letters
        c, n = np.unique(((g * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16), return_counts=True)
        cells.append(c)
        counts.append(n)
    if len(cells) == 1:
        return cells[0].astype(np.int64), counts[0].astype(np.float64)
    total = np.bincount(np.concatenate(cells), np.concatenate(counts), CODES)
    c = np.flatnonzero(total)
    return c, total[c]


def train(docs: DataFrame, lang: Column, wanted: Column) -> tuple[list[str], np.ndarray]:
    """Languages and their trigram log probabilities, from every row that is ``wanted``.

    The counts are a table of ``CODES`` cells for each language, whatever the
    number of rows.
    """
    def run(batches):
        tables: dict[str, np.ndarray] = {}
        for b in batches:
            for t, name in zip(b.column("text"), b.column("lang").to_pylist()):
                c, n = trigrams(t.as_py())
                if name not in tables:
                    tables[name] = np.zeros(CODES)
                tables[name][c] += n
        for name, x in tables.items():
            c = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(c)), pa.array(c), pa.array(x[c].astype(np.int64))], ["lang", "cell", "n"])

    rows = docs.filter(wanted & lang.isNotNull() & docs["text"].isNotNull()).select(docs["text"], lang.alias("lang"))
    got = (rows.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
           .toPandas())
    names = sorted(got["lang"].unique())
    logp = np.zeros((CODES, len(names)))
    for j, name in enumerate(names):
        mine = got[got["lang"] == name]
        x = np.full(CODES, SMOOTH)
        x[mine["cell"].to_numpy()] += mine["n"].to_numpy()
        logp[:, j] = np.log(x / x.sum())
    return names, logp


def weights(cells: np.ndarray, counts: np.ndarray, logp: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Selected languages, their shares, and the log likelihood of each language alone."""
    lp = logp[cells]
    alone = counts @ lp
    chosen, w = [int(alone.argmax())], np.ones(1)
    p = np.exp(lp - lp.max(axis=1, keepdims=True))  # a factor for each trigram changes no comparison
    n = counts.sum()
    penalty = PENALTY * np.log(n + 1)
    while len(chosen) < p.shape[1]:
        mix = p[:, chosen] @ w
        # The likelihood is concave in the shares: no set gains more than this.
        gain = (counts / mix) @ p - n
        gain[chosen] = -np.inf
        trial = int(gain.argmax())
        if gain[trial] <= penalty:
            break
        more, share = [*chosen, trial], np.append(w * 0.9, 0.1)
        q, before = p[:, more], counts @ np.log(mix)
        after = before
        for _ in range(STEPS):
            m = q @ share
            now = counts @ np.log(m)
            share = share * ((counts / m) @ q) / n
            if now - after < 1e-3 and _:
                break
            after = now
        if after - before <= penalty:
            break
        chosen, w = more, share / share.sum()
    return chosen, w, alone


def predict(text: str | None, names: list[str], logp: np.ndarray) -> tuple[str, float, list[str], list[float]]:
    if text is None or not names or not _LETTER.search(text):
        return "und", 0.0, [], []
    cells, counts = trigrams(text)
    if not len(cells):
        return "und", 0.0, [], []
    chosen, w, alone = weights(cells, counts, logp)
    order = np.lexsort((chosen, -w))
    best = chosen[order[0]]
    sure = 1.0 / np.exp(np.minimum(alone - alone[best], 0.0)).sum()
    return (names[best], float(min(1.0, max(0.0, w[order[0]] * sure))), [names[chosen[k]] for k in order],
            [float(w[k]) for k in order])


def identify(docs: DataFrame, names: list[str], logp: np.ndarray) -> DataFrame:
    """(row, lang_pred, score, languages, shares): ``row`` holds every column of ``docs``."""
    def run(batches):
        for b in batches:
            got = [predict(t.as_py(), names, logp) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("row")] + [pa.array([g[k] for g in got], t) for k, t in
                                     enumerate((pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())))],
                ["row", *(n for n, _ in FOUND)])

    src = docs.select(F.struct("*").alias("row"), F.col("text"))
    return src.mapInArrow(run, T.StructType([src.schema["row"], *(T.StructField(n, t) for n, t in FOUND)]))


def with_a_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that have a language; ``und`` rows go.

    Learns from all rows with a language label.  Where no row has one, nothing
    is known about languages and only texts without a letter go.
    """
    names, logp = train(docs, docs["lang"], F.lit(True))
    if not names:
        names, logp = ["?"], np.zeros((CODES, 1))
    return identify(docs, names, logp).filter("lang_pred <> 'und'").select("row.*")
