"""URL filter: rules, and for the rest trust propagated over the link graph.

A rule (allow or block, host, path) fits a url if the url's host is the rule's
or a subdomain of it and the url's path starts with the rule's; the longest
rule wins. Where none fits, the host decides:

- Trust starts from hosts in the share of their pages that rules allow, and
  follows links (personalised PageRank): whom trusted hosts link to is trusted.
- Distrust starts from hosts in the share of their pages that rules block, and
  follows links backwards: who links to blocked hosts is distrusted.
- A host is blocked when its distrust reaches ``LIMIT`` of what a wholly
  blocked host has from its own pages, and exceeds its trust.

Everything is DataFrame expressions. Links are summed up to host edges before
they are shuffled, a hub's edges are dealt over ``SALTS`` keys, and each round
is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, table

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]
DAMPING = 0.85
LIMIT = 0.5
#: A round that adds less than this share of all trust and distrust is the last.
TOLERANCE = 1e-4
MOST_ROUNDS = 60
SALTS = 16
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""[hH][rR][eE][fF]\s*=\s*["']?\s*((?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//[^\s"'<>/?#]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def best_rule(host: Column, path: Column, rules=None) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else NULL."""
    rules = sorted(RULES if rules is None else rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in reversed(rules):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, links): links between different hosts, from the whole html."""
    links = pages.select(url_host(F.col("url")).alias("source"),
                         F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("link"))
    target = F.translate(F.regexp_extract("link", "//(.*)$", 1), _UPPER, _LOWER)
    return (links.select("source", target.alias("target"))
            .where("source <> '' AND target <> '' AND source <> target")
            .groupBy("source", "target").agg(F.count("*").alias("links")))


def _shares(edges: DataFrame) -> DataFrame:
    """(kind, origin, target, share, salt): along links for trust, against them
    for distrust; a host passes on shares by the number of links."""
    both = edges.select(F.lit("trust").alias("kind"), F.col("source").alias("origin"), "target", "links").union(
        edges.select(F.lit("distrust"), "target", "source", "links"))
    total = both.groupBy("kind", "origin").agg(F.sum("links").alias("total"))
    return both.join(total, ["kind", "origin"]).select(
        "kind", "origin", "target", (F.col("links") / F.col("total")).alias("share"),
        F.pmod(F.xxhash64("target"), F.lit(SALTS)).cast("int").alias("salt"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(source, target, links) and (kind, host, seed) -> (kind, host, score).

    score = (1 - damping) * seed + damping * sum of the shares of the scores
    that point to the host; kinds are trust and distrust.
    """
    own = seeds.where("seed > 0").select("kind", "host", (F.lit(1 - damping) * F.col("seed")).alias("score"))
    shares = materialise(_shares(edges), "host-shares")
    scores = materialise(own, "host-scores")
    if shares.isEmpty():
        return scores
    before = scores.agg(F.sum("score")).first()[0] or 0.0
    for _ in range(MOST_ROUNDS):
        salted = scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        passed = (shares.join(salted.withColumnRenamed("host", "origin"), ["kind", "origin", "salt"])
                  .select("kind", F.col("target").alias("host"), (F.lit(damping) * F.col("score") * F.col("share")).alias("score")))
        scores = materialise(passed.union(own).groupBy("kind", "host").agg(F.sum("score").alias("score")), "host-scores")
        now = scores.agg(F.sum("score")).first()[0] or 0.0
        if now - before <= TOLERANCE * now:  # scores only rise, so this bounds what is missing
            break
        before = now
    return scores


def judge(pages: DataFrame, rules=None, trusted: DataFrame | None = None, blocked: DataFrame | None = None) -> DataFrame:
    """A verdict for every row of ``pages`` (page_id, url, html; others ignored).

    page_id, host, path, rule, verdict, trust, distrust. ``trusted`` and
    ``blocked`` (host) are further seeds with full weight. A NULL url or one
    without ``://`` has an empty host and path and is allowed, as is a host
    without any trust or distrust. NULL html has no links. Repeated rows count
    as often as they occur and each give a row.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = split.withColumn("r", best_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", "r.rule", "r.verdict")
    shares = ruled.where("host <> ''").groupBy("host").agg(
        F.avg((F.coalesce("verdict", F.lit("")) == "allow").cast("double")).alias("trust"),
        F.avg((F.coalesce("verdict", F.lit("")) == "block").cast("double")).alias("distrust"))
    seeds = shares.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (kind, seed)"))
    for kind, extra in (("trust", trusted), ("distrust", blocked)):
        if extra is not None:
            seeds = seeds.unionByName(extra.select("host", F.lit(kind).alias("kind"), F.lit(1.0).alias("seed")))
    seeds = seeds.groupBy("kind", "host").agg(F.max("seed").alias("seed"))
    scores = propagate(host_edges(pages.select("url", "html")), seeds)
    hosts = scores.groupBy("host").agg(
        *(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")))
    bad = (F.col("distrust") >= LIMIT * (1 - DAMPING)) & (F.col("distrust") > F.col("trust"))
    zero = F.lit(0.0)
    return ruled.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust"))


def op4_url_trust(spark, sf_dir: str) -> DataFrame:
    """A verdict for every url of ``pages``."""
    return judge(table(spark, sf_dir, "pages"))
