"""URL rules, and link-graph propagation for what no rule decides; DataFrame functions only.

Hosts that the rules allow or block are seeds. Trust is a personalised PageRank from the allowed
seeds along host edges; distrust one from the blocked seeds against them: who links to blocked
hosts is distrusted. Both are compared with a threshold, per host.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import ascii_lower, cut, filled


class Rule(NamedTuple):
    """Fits `host` and its subdomains where the path starts with `path`."""

    verdict: str
    host: str
    path: str


#: Links to a host: with a scheme, or with that of the page.
HREF = r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""
#: Scores are final when no round moves more than this to any host.
SETTLED = 1e-11


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", filled(url))
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null; equal lengths: the first by name.

    The rules are part of the expression, so their number should stay below some thousands.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path))
    fits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in ranked
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(src, dst, links) of links between different hosts; pages need a column `host`."""
    links = pages.where(F.contains(F.lower(F.col(html_col)), F.lit("href"))).select(
        F.col("host").alias("src"),
        F.explode(F.regexp_extract_all(F.col(html_col), F.lit(HREF), 1)).alias("url"),
    )
    url = F.when(F.startswith("url", F.lit("//")), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    edges = links.select("src", host_of(url).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float) -> DataFrame:
    """(kind, host, score), the fixed point of `score = seed + damping * inflow`.

    `edges` are (kind, src, dst, links); `seeds` are (kind, host, seed). A host passes its score on
    in proportion to its links; the score of a host without links goes nowhere. Each round moves on what came in
    in the round before, until that is nothing; one number per round goes to the driver.
    """
    totals = edges.groupBy("kind", "src").agg(F.sum("links").alias("all_links"))
    shares = cut(
        edges.join(totals, ["kind", "src"]).select(
            "kind", "src", "dst", (damping * F.col("links") / F.col("all_links")).alias("share")
        )
    )
    scores = seeds.select("kind", "host", F.col("seed").alias("score"))
    if shares.isEmpty():
        return scores
    scores = moving = cut(scores)
    while True:
        inflow = shares.join(moving.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("score") * F.col("share")).alias("score")
        )
        moving = cut(inflow.groupBy("kind", "host").agg(F.sum("score").alias("score")))
        scores = cut(scores.unionAll(moving).groupBy("kind", "host").agg(F.sum("score").alias("score")))
        if (moving.agg(F.max("score")).first()[0] or 0.0) <= SETTLED:
            return scores


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    damping: float = 0.85,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per row of `pages`: id, host, path, rule, verdict, trust, distrust.

    The longest fitting rule decides. Else the host does: it is blocked if its distrust is at least
    `threshold` and above its trust (both rounded to nine decimals), and allowed otherwise; `damping` is below 1. The seed
    of a host is the share of its pages that rules block or allow. Null urls, and such without
    `://`, have an empty host, which is allowed; null html has no links. Repeated rows count as
    often as they occur, equal rules once; other columns are not looked at. An empty table gives no rows.
    """
    named = pages.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
        F.col(html_col).alias("html"),
    )
    edges = host_edges(named, "html")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionAll(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    ruled = named.select("id", "host", "path", fitting_rule(F.col("host"), F.col("path"), rules).alias("fit"))
    shares = ruled.where("host <> ''").groupBy("host").agg(
        F.avg(F.coalesce(F.col("fit.verdict") == "allow", F.lit(False)).cast("int")).alias("trust"),
        F.avg(F.coalesce(F.col("fit.verdict") == "block", F.lit(False)).cast("int")).alias("distrust"),
    )
    seeds = shares.select(
        "host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "seed")
    ).where("seed > 0")
    scores = propagate(both, seeds, damping)
    hosts = scores.groupBy("host").agg(
        F.round(F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)), 9).alias("trust"),
        F.round(F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)), 9).alias("distrust"),
    )
    by_host = F.when((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return ruled.join(hosts, "host", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
