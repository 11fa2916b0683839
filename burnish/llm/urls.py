"""URL rules, and link-graph propagation for the hosts that no rule judges.

Hosts are nodes.  Edges are the hyperlinks of the pages (counted per pair of hosts) and the
steps between a host and its parent domain, both ways.  Two personalised PageRanks run over
them: trust starts at hosts with pages that a rule allows and follows the edges; distrust
starts at hosts with pages that a rule blocks and follows them backwards.  Beside each runs the rank that a host would have if the seeds were spread over
the hosts like their pages; the quotient is the host's lift.  Both run until they settle, so distrust
travels along chains of links of any length.  A host is blocked when its
distrust has a lift above ``THRESHOLD`` and above that of its trust; otherwise it is allowed.

Edges are pre-aggregated map-side and both ranks run in one loop.  A round is one join and one
aggregation: every host also hands its rank on to itself, so no round is read twice.  Few steps are
broadcast, and several rounds make one job; many are joined by shuffle, and every second round is
written to the shared folder.  Mass at nodes without edges is dropped, not handed back.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and
has no edges, so it is allowed; equal lengths of fitting rules go to the first listed;
repeated rows are each judged and each count as a page; a null html has no links.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnish.operators.skew import is_small
from burnish.session import materialise

# (verdict, host, path) in the order of the rule list.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MOST_RULES = 500  # rules become one expression; longer lists need a join
DAMPING = 0.85
SETTLED = 1e-3  # no rank grows by more than this share of itself any more
STRIDE = 2  # rounds between two looks at the growth, and between two writes of many steps
FAR = 8  # rounds between two writes of few steps
THRESHOLD = 1.5
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: str = "url") -> tuple[Column, Column]:
    """(host, path) of a url column."""
    text = F.col(url).cast("string")
    known = F.coalesce(F.contains(text, F.lit("://")), F.lit(False))
    rest = F.substr(text, F.locate("://", text) + 3)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(F.lit("")), F.when(known, path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    if len(rules) > MOST_RULES:
        raise ValueError("too many rules for one expression")
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))

    def pick(value) -> Column:
        found = F.lit(None).cast("string")
        for rule in reversed(ranked):
            fits = ((host == rule[1]) | F.endswith(host, F.lit("." + rule[1]))) & F.startswith(path, F.lit(rule[2]))
            found = F.when(fits, F.lit(value(rule))).otherwise(found)
        return found

    return pick(lambda r: r[1] + r[2]), pick(lambda r: r[0])


def _parents(hosts: DataFrame) -> DataFrame:
    """(host, parent) for every host and every domain above it that has two labels or more."""
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(0), F.size("l") - 2), lambda i: F.array_join(F.slice(F.col("l"), i + 1, F.size("l")), "."))
    chains = hosts.filter(F.col("host").contains(".")).select(labels.alias("l")).filter(F.size("l") > 2).select(above.alias("c"))
    steps = chains.select(F.explode(F.arrays_zip(F.slice("c", F.lit(1), F.size("c") - 1).alias("host"), F.slice("c", F.lit(2), F.size("c")).alias("parent"))).alias("s"))
    return steps.select("s.*").distinct()


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) from pages (host, html): counted hyperlinks and, as further rows, domain steps."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.withColumn("dst", F.translate(F.regexp_replace("dst", r"^[^@]*@|:\d*$", ""), _UPPER, _LOWER)).filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    links = materialise(links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")), "links")
    hosts = pages.select("host").unionByName(links.select(F.col("dst").alias("host"))).distinct()
    ways = F.array(*[F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), F.lit(1.0).alias("weight")) for a, b in (("host", "parent"), ("parent", "host"))])
    return links.unionByName(_parents(hosts).select(F.explode(ways).alias("w")).select("w.*"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, settled: float = SETTLED) -> DataFrame:
    """edges (src, dst, weight; summed per pair), seeds (kind, host, mass, even) -> (kind, host, rank, even).

    ``kind`` is ``trust``, which follows the edges, or ``distrust``, which follows them backwards.
    A round passes on what arrived in the one before, and adds it up.  Rounds end at the first
    multiple of ``STRIDE`` after which no rank of any host grows by more than ``settled`` of itself,
    which each round brings nearer by the damping; ``rounds`` asks for that many instead.  Where a
    longer run of rounds went past that end, it is done again in shorter ones.
    """
    # Both kinds of every edge, and the step of every host to itself, which keeps its ranks: they come out of one aggregation.
    step = lambda kind, src, dst, weight: F.struct(F.lit(kind).alias("kind"), F.col(src).alias("src"), F.col(dst).alias("dst"), weight.alias("weight"), weight.isNull().alias("keeps"))
    keep = F.lit(None).cast("double")
    ends = [("trust", "src", "dst"), ("distrust", "dst", "src")]
    each = F.array(*[step(k, s, d, F.col("weight")) for k, s, d in ends], *[step(k, h, h, keep) for k, *two in ends for h in two])
    own = seeds.select("kind", F.col("host").alias("src"), F.col("host").alias("dst"), keep.alias("weight"), F.lit(True).alias("keeps"))
    both = edges.filter("weight IS NOT NULL").select(F.explode(each).alias("s")).select("s.*").unionByName(own)
    both = both.groupBy("kind", "src", "dst", "keeps").agg(F.sum("weight").alias("weight"))
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    steps = both.join(out, ["kind", "src"]).select("kind", "src", "dst", "keeps", (F.col("weight") / F.col("all")).alias("p"))
    steps = materialise(steps, "steps")
    few = is_small(steps)
    steps = F.broadcast(steps) if few else steps.hint("merge")
    names = ("rank", "even")
    start = seeds.select("kind", "host", (F.col("mass") * (1 - damping)).alias("rank"), (F.col("even") * (1 - damping)).alias("even"))
    ranks = materialise(start.select("*", *[F.col(c).alias(f"new_{c}") for c in names]), "seeds")
    grows = F.greatest(*[F.coalesce(F.max(F.try_divide(f"new_{c}", c)), F.lit(0.0)) for c in names])

    def passed_on(ranks: DataFrame, turns: int) -> DataFrame:
        moved = {c: F.col(f"new_{c}") * F.col("p") * damping for c in names}
        for _ in range(turns):
            ranks = ranks.withColumnRenamed("host", "src").join(steps, ["kind", "src"]).select(
                "kind",
                F.col("dst").alias("host"),
                *[F.when(F.col("keeps"), F.col(c)).otherwise(moved[c]).alias(c) for c in names],
                *[F.when(F.col("keeps"), 0.0).otherwise(moved[c]).alias(f"new_{c}") for c in names],
            )
            ranks = ranks.groupBy("kind", "host").agg(*[F.sum(c).alias(c) for c in (*names, *[f"new_{c}" for c in names])])
        return materialise(ranks, "ranks")

    if rounds is not None:
        for turn in range(0, rounds, STRIDE):
            ranks = passed_on(ranks, min(STRIDE, rounds - turn))
        return ranks.select("kind", "host", *names)
    most, growth = FAR if few else STRIDE, 1.0
    while growth > settled:
        left = math.log(settled / growth) / math.log(damping)  # rounds, if nothing but the damping shrinks what is passed on
        turns = max(STRIDE, min(most, int(left) // STRIDE * STRIDE))
        ahead = passed_on(ranks, turns)
        now = ahead.agg(grows).first()[0]
        if now > settled or turns <= STRIDE:
            ranks, growth = ahead, now
        else:
            most = max(STRIDE, turns // 2 // STRIDE * STRIDE)
    return ranks.select("kind", "host", *names)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages (page_id, url, html) -> page_id, host, path, rule, verdict of every row."""
    host, path = split_url()
    split = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    per_host = ruled.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("trust"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("distrust"),
    )
    per_host = materialise(per_host, "hosts")
    sums = per_host.agg(*[F.sum(c).alias(c) for c in ("pages", "trust", "distrust")]).first()
    of = lambda c: F.col(c) / F.lit(float(sums[c] or 1))
    named = per_host.filter(F.col("host") != "")
    seeds = reduce(DataFrame.unionByName, [named.select(F.lit(k).alias("kind"), "host", of(k).alias("mass"), of("pages").alias("even")) for k in ("trust", "distrust")])
    ranks = propagate(host_edges(split.select("host", "html")), seeds)
    lift = F.when(F.col("even") > 0, F.round(F.col("rank") / F.col("even"), 9)).otherwise(0.0)
    lifts = ranks.groupBy("host").agg(*[F.max(F.when(F.col("kind") == k, lift)).alias(f"{k}_rank") for k in ("trust", "distrust")])
    hosts = per_host.select("host").join(lifts, "host", "left").na.fill(0.0, ["trust_rank", "distrust_rank"])
    bad = F.col("distrust_rank") > F.greatest("trust_rank", F.lit(THRESHOLD))
    hosts = materialise(hosts.select("host", "trust_rank", "distrust_rank", F.when(bad, "block").otherwise("allow").alias("by_host")), "verdicts")
    done = ruled.join(hosts, "host")
    return done.select("page_id", "host", "path", "rule", F.coalesce("ruled", "by_host").alias("verdict"), F.col("trust_rank").alias("trust"), F.col("distrust_rank").alias("distrust"))
