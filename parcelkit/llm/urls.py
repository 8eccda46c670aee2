"""URL filter: path rules, and trust and distrust spread over the host graph.

Rules judge a url directly. Hosts are judged by what their links say: trust
starts at hosts with allowed urls and follows links forwards (a trusted host
vouches for what it links to); distrust starts at hosts with blocked urls and
follows links backwards (a host answers for what it links to). Both are
personalised PageRanks over weighted host edges, counted in urls: a seed is
worth its allowed or blocked urls. A host is blocked where distrust exceeds
``threshold`` of all evidence, with each url that no rule judges standing for
half a url of trust. The host's verdict holds for its urls that no rule fits.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare, tmp_names
from parcelkit.session import materialize

# (verdict, host and path), fixed by the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING = 0.85
TOLERANCE = 1e-4
THRESHOLD = 0.5
UNJUDGED = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Absolute and scheme-relative links of a page, up to the end of the host.
LINK = r"""(?i)<[^>]*?\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>\\]+)"""


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z in lower case; empty
    for a null url or one without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end to the next ? or #."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule fits
    its host and all subdomains if the path starts with the rule's path; of
    equally long ones the one with the longer host goes first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"), r[1])):
        h, _, p = name.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, links): links between different hosts, counted."""
    each = pages.select(host_of(F.col(f"`{url}`")).alias("src"),
                        F.explode(F.regexp_extract_all(F.col(f"`{html}`"), F.lit(LINK), F.lit(1))).alias("d"))
    return (each.select("src", F.translate("d", UPPER, LOWER).alias("dst")).where("src <> '' and dst <> src")
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of several graphs at once.

    ``edges`` (graph, src, dst, links) and ``seeds`` (graph, host, mass) give
    (graph, host, score), where score solves score = mass + damping * inflow:
    the usual rank divided by 1 - damping, so a host without inflow has its
    mass. Hosts without links pass nothing on. Each round is one equi-join
    and one grouped sum, written to the shared folder; rounds end when the
    total change falls below ``tolerance`` of the seeds' mass, which the
    geometric decay guarantees.
    """
    out = edges.groupBy("graph", "src").agg(F.sum("links").alias("all"))
    # The shares are written, so a round's join meets plain exchanges on both
    # sides and a host with very many links can be split.
    shares = materialize(edges.join(out, ["graph", "src"]).select(
        "graph", "src", "dst", (F.col("links") / F.col("all")).alias("share")), "url-edges")
    seeds = materialize(seeds.where("mass > 0"), "url-seeds")
    total = seeds.agg(F.sum("mass")).first()[0] or 0.0
    flow = seeds.withColumnRenamed("mass", "flow")  # what the last round added
    score = [seeds.withColumnRenamed("mass", "score")]
    rounds = math.ceil(math.log(tolerance) / math.log(damping)) if total and not shares.isEmpty() else 0
    for _ in range(rounds):
        flow = materialize(flow.join(shares, (flow["graph"] == shares["graph"]) & (flow["host"] == shares["src"]))
                           .groupBy(shares["graph"], shares["dst"].alias("host"))
                           .agg((F.lit(damping) * F.sum(F.col("flow") * F.col("share"))).alias("flow")), "url-flow")
        added = flow.agg(F.sum("flow")).first()[0] or 0.0
        score.append(flow.withColumnRenamed("flow", "score"))
        if added <= tolerance * total:
            break
    return reduce(DataFrame.union, score).groupBy("graph", "host").agg(F.sum("score").alias("score"))


def judge(pages: DataFrame, url: str = "url", html: str = "html", rules=RULES, damping: float = DAMPING,
          threshold: float = THRESHOLD, unjudged: float = UNJUDGED) -> DataFrame:
    """``pages`` with struct column ``filter``: host, path, rule, verdict,
    trust and distrust of the host.

    Null urls have empty host and path, fit no rule and are allowed; null
    pages have no links; repeated rows count each; an empty table gives an
    empty result. ``filter`` replaces an input column of that name.
    """
    prepare(pages.sparkSession)
    host, path = host_of(F.col(f"`{url}`")), path_of(F.col(f"`{url}`"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = pages.select(host.alias("host"), path.alias("path")).select("host", verdict.alias("verdict"))
    hosts = materialize(urls.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked"),
        F.count_if(F.col("verdict").isNull()).alias("open")), "url-hosts")
    edges = materialize(host_edges(pages, url, html), "url-links")
    both = edges.select(F.lit("trust").alias("graph"), "src", "dst", "links").union(
        edges.select(F.lit("distrust").alias("graph"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    seeds = hosts.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("graph"), F.col("allowed").cast("double").alias("mass")),
        F.struct(F.lit("distrust").alias("graph"), F.col("blocked").cast("double").alias("mass")))).alias("s"))
    scores = spread(both, seeds.select("s.graph", "host", "s.mass"), damping)
    scores = scores.groupBy("host").agg(
        F.sum(F.when(F.col("graph") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("graph") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"))
    judged = materialize(hosts.join(scores, "host").select(
        "host", "trust", "distrust",
        (F.col("distrust") > threshold * (F.col("trust") + F.col("distrust") + unjudged * F.col("open"))).alias("bad")),
        "url-judged")

    h, p, r, v, j = tmp_names(pages, "url_host", "url_path", "url_rule", "url_verdict", "url_judged")
    rule, verdict = rule_of(F.col(h), F.col(p), rules)
    rows = pages.withColumns({h: host, p: path}).withColumns({r: rule, v: verdict})
    judged = judged.select(F.struct("host", "trust", "distrust", "bad").alias(j))
    rows = rows.join(judged, F.col(h) == F.col(j)["host"], "left")
    result = F.struct(
        F.col(h).alias("host"), F.col(p).alias("path"), F.col(r).alias("rule"),
        F.coalesce(F.col(v), F.when(F.col(j)["bad"], F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce(F.col(j)["trust"], F.lit(0.0)).alias("trust"),
        F.coalesce(F.col(j)["distrust"], F.lit(0.0)).alias("distrust"))
    return rows.withColumn("filter", result).select(*(f"`{c}`" for c in pages.columns if c != "filter"), "filter")
