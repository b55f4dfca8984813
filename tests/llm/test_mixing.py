"""Mixing against a Python model of targets and systematic sampling."""

from collections import defaultdict

import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blockledger.llm import mixing as M


def model_targets(sizes: dict) -> dict:
    """Shares by weight, capped at 3 times the size, the excess reshared."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        w = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / w > 3 * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / w for s in open_}
            break
        for s in full:
            out[s] = 3.0 * sizes[s]
        left -= sum(3 * sizes[s] for s in full)
        open_ -= set(full)
    return out


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text("abcé\U0001F600", min_size=1, max_size=3)), st.integers(0, 1000), min_size=1, max_size=9))
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in M.targets(df).collect()}
    assert got == pytest.approx(model_targets(sizes), rel=1e-9)


def model_copies(rows, target, u):
    """rows: (size, g, id) in any order -> copies in the order largest class first."""
    rows = sorted(rows, key=lambda r: (-r[0].bit_length(), -r[0], r[1], r[2]))
    left, rest, p, out = target, sum(r[0] for r in rows), 0.0, []
    plain, lo = (target / rest if rest else 0.0), 0
    while lo < len(rows):
        c = rows[lo][0].bit_length()
        part = [r for r in rows if r[0].bit_length() == c]
        rate = min(3.0, max(0.0, left / rest)) if rest else plain
        took = [min(3, math.floor(u + (p + (j + 1) * rate)) - math.floor(u + (p + j * rate))) for j in range(len(part))]
        out += [(r, k) for r, k in zip(part, took)]
        left -= float(sum(r[0] * k for r, k in zip(part, took)))
        rest -= sum(r[0] for r in part)
        p += len(part) * rate
        lo += len(part)
    return out


def test_copies_follow_the_model(documents):
    got = M.copies(documents, keep=["doc_id", "source"]).collect()
    by = defaultdict(list)
    for r in got:
        by[r.row.source].append(r)
    words = {s: sum(r.size for r in rs) for s, rs in by.items()}
    goal = model_targets(words)
    for s, rs in by.items():
        assert all(r.source_size == words[s] and r.target == pytest.approx(goal[s]) for r in rs)
        assert all(0 <= r.copies <= 3 for r in rs)
        name = "17:" + ("null" if s is None else "=" + s)
        u = int(hashlib.md5(name.encode()).hexdigest()[:8], 16) / 2 ** 32
        key = lambda r: (r.size, (r.row.doc_id or 0) % M.GROUPS, -1 if r.row.doc_id is None else r.row.doc_id)
        want = model_copies([key(r) for r in rs], rs[0].target, u)
        assert sorted((key(r), r.copies) for r in rs) == sorted(want)


def test_mix_keeps_columns_and_repeats_rows(documents):
    mix = M.mixed(documents)
    assert mix.columns == documents.columns
    taken = defaultdict(int)
    for r in M.copies(documents).collect():
        taken[r.row] += r.copies
    from collections import Counter
    got = Counter(map(tuple, mix.collect()))
    assert got == Counter({tuple(k): v for k, v in taken.items() if v})


def test_no_words_and_no_rows(spark, no_documents):
    assert M.copies(no_documents).collect() == []
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.copies) for r in M.copies(df).collect()] == [(0, 0.0, 0)] * 2


def test_each_target_is_met(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "source")
    rows = M.copies(docs, keep=["source"]).selectExpr("row.source", "size", "copies", "target").groupBy("source").agg(
        {"target": "max"}).collect()
    got = M.copies(docs, keep=["source"]).selectExpr("row.source as source", "size * copies as taken").groupBy("source").sum("taken").collect()
    taken = {r[0]: r[1] for r in got}
    assert all(abs(taken[r[0]] - r[1]) <= 0.002 * r[1] for r in rows)
