"""Spelling variants against brute force, and the composition against all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from blockledger.llm import queries, variants
from blockledger.llm.common import saved

SMALL = "/root/testdata/sf0.001"


def near(v: str, w: str) -> bool:
    """Whether one code point inserted, deleted or replaced makes v of w."""
    if len(v) > len(w):
        v, w = w, v
    if v == w or len(w) - len(v) > 1:
        return False
    k = next((i for i in range(len(v)) if v[i] != w[i]), len(v))
    return v[k + (len(v) == len(w)):] == w[k + 1:]


def words_of(docs: list[tuple]) -> Counter:
    out: Counter = Counter()
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return out


def brute(n: dict[str, int]) -> set[tuple]:
    by: dict[str, list] = {w: [] for w in n}
    for v, w in combinations(n, 2):
        if near(v, w):
            by[v].append(w)
            by[w].append(v)
    form = {}
    for w, ws in by.items():
        best = min(ws, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n[w], len(by[w]), n[form[w]] if form[w] else None) for w in n}


def random_words(r: random.Random, letters: str, count: int) -> list[str]:
    return sorted({"".join(r.choice(letters) for _ in range(r.randint(0, 7))) for _ in range(count)})


@pytest.mark.parametrize("seed", range(8))
def test_composition_accepts_each_near_pair_once(seed):
    r = random.Random(seed)
    words = random_words(r, "abé"[:1 + seed % 3], 200)
    got = [tuple(sorted(p)) for p in variants.OneEdit(variants.Acceptor(words)).pairs()]
    assert len(got) == len(set(got))
    assert set(got) == {p for p in combinations(words, 2) if near(*p)}


def test_acceptor_is_minimal():
    a = variants.Acceptor(["tap", "taps", "top", "tops"])
    assert len(a.arcs) == 5  # t, a|o share what follows: p, then the end with or without s


@pytest.mark.parametrize("at_once", [1, 3, 40, 10 ** 6])
def test_every_way_of_spreading_gives_the_same(spark, at_once):
    """From one partition of the whole vocabulary to states expanded up to single words."""
    r = random.Random(3)
    n = {w: r.choice([5, 6, 30, 200, 1000]) for w in random_words(r, "abc", 160) if w}
    vocab = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    got = [tuple(x) for x in variants.grouped(saved(vocab, "t"), at_once=at_once).collect()]
    assert len(got) == len(n) and set(got) == brute(n)


def test_query_matches_brute_force(spark):
    docs = [tuple(x) for x in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    n = {w: c for w, c in words_of(docs).items() if c >= 5 and len(w) >= 6}
    got = queries.op12_spelling_variants(spark, SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(n) > 100 and set(rows) == brute(n)


def test_awkward_rows(spark, documents, no_documents):
    docs = [(x.doc_id, x.text) for x in documents.collect()]
    n = {w: c for w, c in words_of(docs).items() if c >= 5 and len(w) >= 6}
    assert {tuple(x) for x in variants.spelling_variants(documents).collect()} == brute(n)
    assert variants.spelling_variants(no_documents).count() == 0


def test_letters_and_very_long_words(spark):
    long = "ab" * 20_000
    texts = [(1, f"{long} {long}x École ÉCOLE école eco-les naïves naives Ÿoooooo straße straßen")] * 6
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.word: r for r in variants.spelling_variants(df, length=5).collect()}
    assert got[long].n_near == 1 and got[long + "x"].n == 6
    assert got["école"].n == 6 and got["École"].n == 12 and "eco" not in got  # only A-Z are lower-cased
    assert got["naïves"].n_near == 1 and got["oooooo"].n == 6 and got["straße"].n_near == 1
    assert all(r.form is None for r in got.values())


def test_chain_of_forms_and_ties(spark):
    n = {"abcdef": 5, "abcdeg": 25, "abcdxg": 125, "abydxg": 625, "zzzzzz": 5, "zzzzzy": 25, "zzzzzx": 25}
    vocab = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: r for r in variants.grouped(saved(vocab, "t")).collect()}
    assert got["abcdef"].root == "abydxg" and got["abcdef"].form == "abcdeg"
    assert got["zzzzzz"].form == "zzzzzx" and got["zzzzzz"].n_near == 2
