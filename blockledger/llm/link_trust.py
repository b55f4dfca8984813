"""URL filters with link-graph propagation, in DataFrame operations only.

Rules are host suffixes with a path prefix; the longest rule that fits decides.
Where none fits, the host's standing in the link graph does: trust spreads from
the hosts of allowed pages along host edges, distrust from the hosts of blocked
pages against them, both as personalised PageRank.  A host is blocked when its
distrust exceeds ``RATIO`` times its trust, both in seed pages (rank times all
seed pages of that side), so that seeds it has no path from cannot switch it.

Host edges: hyperlinks between hosts, counted, and a weak link each way between
a host and its parent domain (down to two labels) where both are hosts of pages
or of links.  A parent that is neither is not made up, so hosts that share only
a registered domain do not meet.  Ranks move along an edge by its share of its
host's weight, and of at least 1: a host whose links to its family weigh less
passes on that part only.  Mass of a host that has no edges out, or keeps part,
leaves; giving it back to the seeds would only multiply all ranks of a side by
one factor.  Links are pre-aggregated to one row for each pair of hosts before
any join; trust and distrust move in the same joins, ranks are written to the
shared folder every few rounds, and the rounds end early once no rank moves.

Cases: a null url, or one without ``://``, has an empty host and path, no rule
and no links, and is allowed; a null page has no links; repeated rows count as
links and seeds of their own and get equal verdicts; without seeds every host
keeps rank 0 and unruled pages are allowed; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockledger.llm.common import lower_ascii, saved

DAMPING = 0.85
ROUNDS = 20
RATIO = 1.0
FAMILY = 0.1  # weight of a link between a host and its parent domain; a hyperlink weighs 1
STILL = 1e-12  # the largest change of a rank that counts as none

#: Fixed values: (verdict, rule).
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

_HREF = r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s<>]+)"""


def host_of(url: Column) -> Column:
    after = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, lower_ascii(F.regexp_extract(after, r"^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    after = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    rest = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, rest).otherwise("")


def suffixes(host: Column) -> Column:
    """The host and its parent domains: one for each label."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def with_rules(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """(page_id, host, path, html, rule, ruled): the longest rule that fits, and what it says.

    A list of rules becomes one expression; a table of rules (verdict, rule)
    is joined on the host suffixes instead, for lists too long for that.
    """
    df = pages.select(F.col("page_id").alias("page_id"), F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
                      F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"), F.col("html").alias("html"))
    if isinstance(rules, DataFrame):
        return _joined(df, rules)
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # the longest is tried first
        domain, _, path = text.partition("/")
        fits = ((F.col("host") == domain) | F.col("host").endswith("." + domain)) & F.col("path").startswith("/" + path)
        rule, ruled = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(ruled)
    return df.withColumn("rule", rule).withColumn("ruled", ruled)


def _joined(df: DataFrame, rules: DataFrame) -> DataFrame:
    r = rules.select(F.col("verdict").alias("says"), F.col("rule").alias("r"),
                     F.substring_index("rule", "/", 1).alias("domain"),
                     F.expr("substring(rule, instr(rule, '/'), length(rule))").alias("prefix")).distinct()
    urls = df.select("host", "path").distinct()
    best = (urls.withColumn("domain", F.explode(suffixes(F.col("host")))).join(r, "domain")
            .filter(F.col("path").startswith(F.col("prefix")))
            .groupBy("host", "path").agg(F.max(F.struct(F.length("r"), "r", "says")).alias("m"))
            .select("host", "path", F.col("m.r").alias("rule"), F.col("m.says").alias("ruled")))
    return df.join(best, ["host", "path"], "left").select("page_id", "host", "path", "html", "rule", "ruled")


def host_edges(df: DataFrame) -> DataFrame:
    """(src, dst, n) between different hosts, from pages (host, html)."""
    from_page = df.filter("host <> ''")
    href = from_page.select("host", F.explode(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))).alias("href"))
    linked = href.select(F.col("host").alias("src"), host_of(F.concat(
        F.when(F.col("href").startswith("//"), F.lit("x:")).otherwise(F.lit("")), F.col("href"))).alias("dst"))
    linked = linked.filter("dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    hosts = from_page.select("host").unionByName(linked.select(F.col("dst").alias("host"))).distinct()
    parent = F.expr("substring(host, instr(host, '.') + 1, length(host))")
    up = hosts.select(F.col("host").alias("src"), parent.alias("dst"))
    up = up.filter("src <> dst and instr(dst, '.') > 0").join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi")
    tree = up.select("src", "dst").unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return (linked.withColumn("n", F.col("n").cast("double")).unionByName(tree.withColumn("n", F.lit(FAMILY)))
            .groupBy("src", "dst").agg(F.sum("n").alias("n")))


def personalised_rank(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(side, host, rank): rank mass restarts at the seeds (side, host, weight) and follows ``edges`` (side, src, dst, n).

    The sides are walks of their own that share the joins.
    """
    totals = {r["side"]: float(r["w"]) for r in seeds.groupBy("side").agg(F.sum("weight").alias("w")).collect()}
    total = F.lit(None).cast("double")
    for side, w in totals.items():
        total = F.when(F.col("side") == side, w).otherwise(total)
    start = saved(seeds.select("side", "host", (F.col("weight") / total).alias("s")), "trust-seeds")
    out = edges.groupBy("side", "src").agg(F.greatest(F.sum("n"), F.lit(1.0)).alias("all"))
    steps = saved(edges.join(out, ["side", "src"]).select("side", F.col("src").alias("host"), "dst",
                                                          (damping * F.col("n") / F.col("all")).alias("w")), "trust-steps")
    restart = start.select("side", "host", ((1 - damping) * F.col("s")).alias("rank"))
    rank = last = saved(start.select("side", "host", F.col("s").alias("rank")), "trust-rank")
    for k in range(rounds):
        moved = steps.join(rank, ["side", "host"]).select("side", F.col("dst").alias("host"), (F.col("w") * F.col("rank")).alias("rank"))
        rank = moved.unionByName(restart).groupBy("side", "host").agg(F.sum("rank").alias("rank"))
        if k % 5 == 4 or k == rounds - 1:
            rank = saved(rank, "trust-rank")
            change = (rank.unionByName(last.withColumn("rank", -F.col("rank"))).groupBy("side", "host")
                      .agg(F.abs(F.sum("rank")).alias("d")).agg(F.max("d")).first()[0])
            last = rank
            if (change or 0.0) <= STILL:
                break
    return rank


def standing(ruled: DataFrame, rounds: int = ROUNDS, ratio: float = RATIO) -> DataFrame:
    """(host, trust, distrust, method) of each host, from pages (host, html, ruled)."""
    edges = saved(host_edges(ruled), "trust-edges")
    votes = saved(ruled.filter("host <> '' and ruled is not null").groupBy(F.col("ruled").alias("side"), "host")
                  .agg(F.count("*").alias("weight")), "trust-votes")
    forth = edges.select(F.lit("allow").alias("side"), "src", "dst", "n")
    back = edges.select(F.lit("block").alias("side"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    ranks = personalised_rank(forth.unionByName(back), votes, rounds)
    of = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("rank"))), F.lit(0.0))
    both = ranks.groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust"))
    pages = {r["side"]: float(r["n"]) for r in votes.groupBy("side").agg(F.sum("weight").alias("n")).collect()}
    t, d = F.col("trust") * pages.get("allow", 0.0), F.col("distrust") * pages.get("block", 0.0)
    # Rounded, as the order of the sums in the ranks moves their last digits; an even host is allowed.
    bad = F.round(F.try_divide(d, t + d), 9) > round(ratio / (1 + ratio), 9)
    return both.withColumn("method", F.when(bad, "block").otherwise("allow"))


def judged(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame | None = None, rounds: int = ROUNDS,
           ratio: float = RATIO) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of each row of ``pages``."""
    ruled = with_rules(pages, RULES if rules is None else rules)
    hosts = saved(standing(ruled, rounds, ratio), "trust-hosts")
    return (ruled.drop("html").join(hosts, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("ruled", "method", F.lit("allow")).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))
