"""URL rules against Python, and ranks against power iteration in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockledger.llm import link_trust as T

URLS = ["http://a.net/x", "https://M.Example.NET/en/1?q", "http://example.net/en", "http://example.net/en/", "http://x.example.com/de/5#t",
        "http://example.com/fr/", "http://w.org/fr/1", "http://w.org/en/", "http://net", "http://net/", "http://anet/", None, "", "x/y",
        "ftp://h.org:80/fr/", "://a.net/p", "http://u@a.net/z", "http://b.org?x=/fr/", "http://É.Org/fr/ü", "HTTP://a.net//", "a://b://c/d"]


def model(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for _, rule in T.RULES:
        d, p = rule.split("/", 1)
        if (host == d or host.endswith("." + d)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best


@pytest.fixture()
def pages(spark):
    html = ['<a href="http://w.org/fr/">', "<A HREF='//evil.test/x'><a href=/self>", None, '<a href="https://A.net/">' * 3]
    rows = [(k, u, html[k % 4], 1, "r") for k, u in enumerate(URLS * 2)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, n int, rule string")


def test_rules(spark, pages):
    table = spark.createDataFrame(T.RULES, "verdict string, rule string")
    for rules in (T.RULES, table):
        got = {r.page_id: (r.host, r.path, r.rule, r.ruled) for r in T.with_rules(pages, rules).collect()}
        says = {rule: v for v, rule in T.RULES}
        for k, u in enumerate(URLS * 2):
            host, path, rule = model(u)
            assert got[k] == (host, path, rule, says.get(rule)), u


def test_rank_is_power_iteration(spark):
    r = np.random.default_rng(0)
    n = 12
    w = r.integers(0, 3, (n, n)) * (1 - np.eye(n, dtype=int))
    w[3] = 0  # a host without links
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", float(w[i, j])) for i in range(n) for j in range(n) if w[i, j]], "src string, dst string, n double")
    seeds = spark.createDataFrame([("h0", 3), ("h5", 1)], "host string, weight long")
    both = [df.withColumn("side", F.explode(F.array(F.lit("a"), F.lit("b")))) for df in (edges, seeds)]
    s = np.zeros(n)
    s[0], s[5] = 0.75, 0.25
    p = w / np.maximum(w.sum(1, keepdims=True), 1)
    x = s
    for _ in range(7):
        x = 0.85 * x @ p + 0.15 * s
    rows = T.personalised_rank(*both, rounds=7).collect()
    for side in "ab":
        got = {r.host: r.rank for r in rows if r.side == side}
        assert np.allclose([got.get(f"h{i}", 0) for i in range(n)], x)


def test_edges(spark):
    rows = [("a.x.test", '<a href="http://b.test/1"><a href="//b.test"><a href="/in"><a href="http://a.x.test/me">'),
            ("c.x.test", "<a href=https://b.test:8/>"), ("b.test", None), ("", '<a href="http://b.test/">')]
    got = {(r.src, r.dst): r.n for r in T.host_edges(spark.createDataFrame(rows, "host string, html string")).collect()}
    # Nothing is called x.test, so the two hosts below it do not meet.
    assert got == {("a.x.test", "b.test"): 2, ("c.x.test", "b.test:8"): 1}
    got = {(r.src, r.dst): r.n for r in T.host_edges(
        spark.createDataFrame(rows + [("x.test", '<a href="//a.x.test">')], "host string, html string")).collect()}
    assert got == {("a.x.test", "b.test"): 2, ("c.x.test", "b.test:8"): 1, ("a.x.test", "x.test"): T.FAMILY,
                   ("x.test", "a.x.test"): 1 + T.FAMILY, ("c.x.test", "x.test"): T.FAMILY, ("x.test", "c.x.test"): T.FAMILY}


def test_hosts_of_one_domain_differ(spark):
    rows = [(1, "http://bad.net/", None), (2, "http://a.x.test/", '<a href="http://bad.net/">' * 2), (3, "http://x.test/", None),
            (4, "http://good.org/fr/", '<a href="http://b.x.test/">'), (5, "http://b.x.test/", None), (6, "http://c.x.test/", None)]
    got = {r.page_id: (r.verdict, r.trust, r.distrust) for r in T.judged(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2][0] == "block" and got[5][0] == "allow"
    # Family links carry little: the sibling's distrust reaches the trusted host weakened twice.
    assert 0 < got[5][2] < 0.05 * got[2][2] and 0 < got[2][1] < 0.05 * got[5][1]


def test_rounds_end_when_nothing_moves(spark):
    edges = spark.createDataFrame([("a", "h", "i", 1.0)], "side string, src string, dst string, n double")
    seeds = spark.createDataFrame([("a", "h", 2)], "side string, host string, weight long")
    few, many = (sorted(tuple(r) for r in T.personalised_rank(edges, seeds, rounds=k).collect()) for k in (10, 10_000))
    assert few == many and [r[1] for r in few] == ["h", "i"]


def test_distrust_spreads_against_links(spark):
    rows = [(1, "http://bad.net/", None), (2, "http://liker.test/", '<a href="http://bad.net/">' * 9),
            (3, "http://good.org/fr/", '<a href="http://liked.test/">'), (4, "http://liked.test/", None), (5, "http://other.test/", None)]
    got = {r.page_id: r.verdict for r in T.judged(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_large_hosts_elsewhere_do_not_switch_a_host(spark):
    rows = [(1, "http://bad.net/", None), (2, "http://liker.test/", '<a href="http://bad.net/">'),
            (3, "http://fan.test/", '<a href="http://liker.test/">'),
            (4, "http://good.org/fr/", '<a href="http://mixed.test/">'), (5, "http://good.org/fr/2", None),
            (6, "http://worse.net/", None), (7, "http://worse.net/2", None), (8, "http://worse.net/3", None),
            (9, "http://mixed.test/", '<a href="http://worse.net/">'),
            (10, "http://good.org/fr/3", '<a href="http://better.test/">'), (11, "http://better.test/", '<a href="http://worst.net/">'),
            (12, "http://worst.net/", None)]
    want = {2: "block", 3: "block", 9: "block", 11: "allow"}
    for more in ([], ["http://large.net/"], ["http://large.org/fr/"]):
        all_rows = rows + [(100 + k, u, None) for u in more for k in range(60)]
        got = {r.page_id: r.verdict for r in T.judged(spark.createDataFrame(all_rows, "page_id long, url string, html string")).collect()}
        assert {k: got[k] for k in want} == want, more


def test_judged_rows(spark, pages):
    got = T.judged(pages, rounds=5).collect()
    assert len(got) == len(URLS) * 2
    for r in got:
        host, path, rule = model((URLS * 2)[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if rule:
            assert r.verdict == {v: k for k, v in T.RULES}[rule]
        if not host:
            assert r.verdict == "allow"
    assert T.judged(pages.limit(0)).collect() == []
