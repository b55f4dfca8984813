"""The n-gram join against all pairs in Python."""

import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockledger.llm import ngram_join as J
from blockledger.llm.common import discard, saved
from blockledger.llm.graph import components
from tests_llm_brute import roots_of, shingles


def brute(rows, per_cent=90):
    """(id, set size, smallest id of the component) of each row."""
    roots = roots_of(rows, per_cent)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return Counter((i, len(shingles(t)), least.get(r) if shingles(t) else i) for (i, t), r in zip(rows, roots))


@pytest.mark.parametrize("per_cent", [90, 80, 60])
def test_components(documents, per_cent):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = Counter(map(tuple, J.near_duplicate_components(documents, per_cent).collect()))
    assert got == brute(rows, per_cent)


def test_group_without_a_hub(spark):
    """A chain: neighbours are linked, far members are not; hardly any link goes through one leader."""
    words = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(words[4 * i:4 * i + 120])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, J.near_duplicate_components(df).collect()))
    assert got == brute(rows)
    assert len({r[2] for r in got}) < 40


def test_blocks_are_all_compared(documents, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert Counter(map(tuple, J.near_duplicate_components(documents).collect())) == brute(rows)


def test_segments_of_the_count_add_up(documents, monkeypatch):
    monkeypatch.setattr(J, "SEGMENT", 16)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert Counter(map(tuple, J.near_duplicate_components(documents).collect())) == brute(rows)


def test_empty_table(no_documents):
    assert J.near_duplicate_components(no_documents).collect() == []
    assert J.one_of_each(no_documents).columns == no_documents.columns
    assert J.one_of_each(no_documents).collect() == []


def test_one_of_each(documents):
    kept = J.one_of_each(documents)
    assert kept.columns == documents.columns
    ids = [r.doc_id for r in kept.collect()]
    named = {r.component_id for r in J.near_duplicate_components(documents).collect() if r.doc_id is not None}
    assert sorted(i for i in ids if i is not None) == sorted(named)
    assert ids.count(None) == 0  # its copies have ids


def test_sketch_never_overstates():
    r, cuts = np.random.default_rng(1), J.Cuts(90)
    for n in (1, 5, 40, 700, 3000):
        a = r.integers(0, 2 ** 63, n, np.int64).astype(np.uint64)
        b = np.concatenate([a[n // 7:], r.integers(0, 2 ** 63, n // 9, np.int64).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        assert J.differing(cuts.sketch(a), cuts.sketch(b)) <= len(np.setxor1d(a, b))


def test_linked_sets_share_a_signature():
    r, cuts = np.random.default_rng(2), J.Cuts(90)
    for n in list(range(10, 60)) + [200, 1000, 5000]:
        for _ in range(20):
            a = np.unique(r.integers(0, 2 ** 63, n, np.int64).astype(np.uint64))
            gone = int(r.integers(0, n // 10 + 1))
            new = int(r.integers(0, n // 10 + 1))
            b = np.unique(np.concatenate([r.permutation(a)[gone:], r.integers(0, 2 ** 63, new, np.int64).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both * 100 >= 90 * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
                assert len(np.intersect1d(cuts.signatures(a), cuts.signatures(b)))


def test_components_of_a_graph(spark):
    chain = [(i, i + 1) for i in range(0, 50)] + [(100, 7), (200, 201), (5, 5), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, 100: 0, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_large_group_of_texts_below_the_threshold(spark, monkeypatch):
    """Near copies of one text, too far from each other to be linked: no list of likely pairs is written."""
    written = {}

    def counted(df, name, **options):
        out = saved(df, name, **options)
        written[name] = written.get(name, 0) + out.count()
        return out
    saved = J.saved
    monkeypatch.setattr(J, "saved", counted)
    r, hub, rows = np.random.default_rng(4), [f"w{k}" for k in range(200)], []
    for i in range(150):
        w = list(hub)
        for at in r.choice(25, 3, replace=False) * 8:
            w[at] = f"x{r.integers(10 ** 6)}"
        rows.append((i, " ".join(w)))
    rows.append((150, rows[140][1].replace("w199", "last")))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, J.near_duplicate_components(df).collect())) == brute(rows)
    assert sum(n for name, n in written.items() if name in ("join-pairs", "join-star", "join-forest", "join-all", "join-found")) < 10 * len(rows)


def test_graph_of_a_family_has_few_edges(spark, monkeypatch):
    """Near copies dealt over many batches: a bucket's leaders hang on one, so edges do not multiply."""
    graphs = []

    def counted(edges):
        e = edges.filter("u <> v").distinct()
        graphs.append((e.count(), e.select("u").union(e.select("v")).distinct().count()))
        return components(edges)
    monkeypatch.setattr(J, "components", counted)
    r, hub, rows = np.random.default_rng(6), [f"w{k}" for k in range(200)], []
    for i in range(300):
        w = list(hub)
        for at in r.choice(25, 3, replace=False) * 8:
            w[at] = f"x{r.integers(10 ** 6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(30)
    assert len(J.near_duplicate_components(df).collect()) == 300
    large = [(e, n) for e, n in graphs if n >= 300]
    assert large and all(e < 2 * n for e, n in large)


def test_hardly_any_set_signs_empty_fragments():
    """Sets of one size class at 80 per cent have no signature in common by chance."""
    r, cuts = np.random.default_rng(3), J.Cuts(80)
    seen = Counter()
    for _ in range(400):
        h = np.unique(r.integers(0, 2 ** 63, int(r.integers(150, 400)), np.int64).astype(np.uint64) * np.uint64(2))
        seen.update(cuts.signatures(h).tolist())
    assert sum(n for n in seen.values() if n > 1) < 40


def test_buckets_in_slices(documents, monkeypatch):
    """Buckets formed slice by slice are those formed at once, and no slice is left on disk."""
    prof, removed = J.profile(documents), []
    at_once = Counter(map(tuple, J.bucket_members(prof).collect()))
    monkeypatch.setattr(J, "ONE_PASS", 0)
    monkeypatch.setattr(J, "discard", lambda *frames: removed.extend(f.count() for f in frames) or discard(*frames))
    sliced = J.bucket_members(prof)
    assert Counter(map(tuple, sliced.collect())) == at_once
    assert len(removed) == len(J.SLICES) and max(removed) < len(at_once) / 2


def test_saved_leaves_no_shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def files():
        return {f for d in dirs for f in Path(str(d)).glob("*/shuffle_*.data")}
    before = files()
    assert len(saved(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count(), "shuffled").collect()) == 7
    for _ in range(20):
        left = [f for f in files() - before if f.exists()]
        if not left:
            break
        time.sleep(0.5)
    assert not left
