"""URL filters: host and path rules, and trust that spreads over the link graph of hosts.

A page that a rule fits gets the rule's verdict. The rest are judged by host: personalised PageRank
from the hosts of allowed pages gives trust along links, the same from the hosts of blocked pages
against the direction of links gives distrust (who links to bad hosts is bad). A host is blocked
where its distrust is a larger share than the threshold. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``rule`` is a host and a path prefix, like ``net/de/``; ``verdict`` is allow or block."""

    verdict: str
    rule: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.rule.partition("/")
        return ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to a slash, question mark, hash or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does. Of equally long rules the first in text order wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.rule), [-ord(c) for c in r.rule])):
        fits = r.fits(host, path)
        rule, verdict = F.when(fits, F.lit(r.rule)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links): how many links pages of one host have to another; addresses without a host stay on their own."""
    found = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)\b(?:href|src)\s*=\s*["']?((?:https?:)?//[^\s"'<>]+)"""), 1))
    target = F.regexp_replace(F.col("link"), "^//", "http://")
    links = pages.select(host_of(F.col("url")).alias("src"), found.alias("link")).select("src", host_of(target).alias("dst"))
    return links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6, rounds_per_stage: int = 4) -> DataFrame:
    """(host, trust, distrust) of personalised PageRank.

    ``seeds`` has (host, allowed, blocked) page counts. Each walk starts on its seeds in proportion to
    their counts, follows a link with the chance ``damping`` (a host without any ends the walk, so what
    is left goes back to the seeds by scaling) and else starts again. Trust follows links, distrust
    goes against them. Steps go on until ``rounds_per_stage`` of them move less than ``tolerance`` of all scores
    (which start at 1 a kind), as they do in the end at any length of path: each step shrinks what is missing by ``damping``.
    """
    totals = seeds.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
    start = seeds.crossJoin(F.broadcast(totals)).select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.try_divide(F.col("allowed"), F.col("a")).alias("start")),
        F.struct(F.lit("distrust").alias("kind"), F.try_divide(F.col("blocked"), F.col("b")).alias("start")),
    )).alias("s")).select("host", "s.kind", "s.start").where("start > 0")
    both = edges.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "links"),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "links"),
    )).alias("e")).select("e.*")
    out = both.groupBy("kind", "host").agg(F.sum("links").alias("out"))
    steps = staged(both.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("links") / F.col("out")).alias("share")), "steps")
    start = staged(start, "seeds")
    score, moving = start.withColumnRenamed("start", "score"), True
    while moving:
        before = score
        for _ in range(rounds_per_stage):
            moved = score.join(steps, ["kind", "host"]).select("kind", F.col("to").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
            again = start.select("kind", "host", ((1 - damping) * F.col("start")).alias("score"))
            score = moved.union(again).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        score = staged(score, "score")
        change = before.withColumn("score", -F.col("score")).union(score).groupBy("kind", "host").agg(F.abs(F.sum("score")).alias("d"))
        moving = (change.agg(F.sum("d")).head()[0] or 0.0) > tolerance
    total = F.broadcast(score.groupBy("kind").agg(F.sum("score").alias("total")))  # two rows
    share = score.join(total, "kind").select("host", "kind", (F.col("score") / F.col("total")).alias("share"))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("share"))), F.lit(0.0)).alias(kind)
    return share.groupBy("host").agg(of("trust"), of("distrust"))


def judged(pages: DataFrame, rules: list[Rule], threshold: float = 0.5) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, trust, distrust.

    ``verdict`` is the longest fitting rule's, else block where distrust / (trust + distrust) of the
    host is over ``threshold``, else allow; so hosts that no walk reaches, and pages without a host,
    are allowed. Null urls and ones without ``://`` have an empty host and path, null html has no
    links. Repeated rows get equal results; an empty table gives no rows.
    """
    spark = pages.sparkSession
    if not pages.take(1):
        return spark.createDataFrame([], f"page_id {pages.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string, trust double, distrust double")
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    ruled_pages = named.withColumns({"rule": rule, "ruled": verdict})
    seeds = staged(
        ruled_pages.where("host <> ''").groupBy("host").agg(F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked"))
        .where("allowed + blocked > 0"), "host_seeds",
    )
    scores = staged(propagated(staged(host_edges(pages), "host_edges"), seeds), "host_scores")
    bad = F.coalesce(F.try_divide(F.col("distrust"), F.col("trust") + F.col("distrust")) > threshold, F.lit(False))
    return ruled_pages.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
