"""URL verdicts from rules and from trust that spreads over links between hosts.

Rules decide the urls they fit. Every other url gets its host's verdict: trust
starts at hosts where rules allow pages, by their share, and follows links
(personalised PageRank); distrust starts at hosts where rules block pages, by
their share, and follows links backwards, since a host that links to blocked
ones deserves it. A host is blocked where distrust outweighs trust by the threshold.

Both walks run as one: a table of directed, weighted edges (kind, source,
target), joined with the scores of (kind, host) and added up per target each
round. Links are added up per pair of hosts before anything else, and scores
before their shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.common import saved

DAMPING = 0.85
SAVED_ROUNDS = 4
TOLERANCE = 1e-4
THRESHOLD = 1.0


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, such as ``example.com/en/``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path begins the url's; null if none fits."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def rule_verdict(rule: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.text, F.lit(r.verdict)).otherwise(out)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """(``source``, ``target``, ``n``): links between different hosts in the pages' html, added up."""
    found = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""), 1))
    links = pages.select(F.col("host").alias("source"), found.alias("link"))
    found = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))  # the page's scheme; only the host counts
    links = links.withColumn("link", found).filter(F.col("link").contains("://"))
    links = links.select("source", host_of(F.col("link")).alias("target")).filter("source <> '' and target <> '' and source <> target")
    return links.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))


def spread(spark: SparkSession, seeds: DataFrame, links: DataFrame, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """(``kind``, ``host``, ``score``) after personalised PageRank from ``seeds`` (kind, host, weight).

    Kind 'trust' follows links, kind 'distrust' follows them backwards. Weights
    are made to add up to one per kind. What reaches a host without further
    links is not passed on. Without ``rounds``, the walk ends when a few rounds
    reach no new host and move the scores by less than the tolerance: the
    damping bounds the rounds after the last host was reached (below 75).
    """
    directed = links.select(F.lit("trust").alias("kind"), "source", "target", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "n")
    )
    out = directed.groupBy("kind", "source").agg(F.sum("n").alias("all"))
    edges = saved(spark, directed.join(out, ["kind", "source"]).select("kind", "source", "target", (F.col("n") / F.col("all")).alias("share")), "host-edges")
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))
    start = saved(spark, seeds.join(F.broadcast(total), "kind").select("kind", "host", (F.col("weight") / F.col("all")).alias("start")), "host-seeds")  # two rows
    now = start.withColumnRenamed("start", "score")
    if edges.isEmpty():
        return now
    back = start.select("kind", "host", ((1 - damping) * F.col("start")).alias("score"))
    done = 0
    while rounds is None or done < rounds:
        after = now
        for _ in range(SAVED_ROUNDS if rounds is None else min(SAVED_ROUNDS, rounds - done)):
            passed = after.withColumnRenamed("host", "source").join(edges, ["kind", "source"]).select("kind", F.col("target").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
            after = passed.unionByName(back).groupBy("kind", "host").agg(F.sum("score").alias("score"))
            done += 1
        after = saved(spark, after, f"host-scores-{done}")
        both = after.withColumnRenamed("score", "new").join(now, ["kind", "host"], "full")
        change = both.agg(F.sum(F.abs(F.coalesce("new", F.lit(0.0)) - F.coalesce("score", F.lit(0.0)))).alias("moved"), F.count_if(F.col("score").isNull()).alias("reached")).first()
        now = after
        if (change["moved"] or 0.0) < TOLERANCE and not change["reached"]:
            break
    return now


def judge(spark: SparkSession, pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """(``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``) for every row of ``pages`` (page_id, url, html).

    A url without a host has no rule and is allowed, as is one whose host no
    walk reaches. Rows may repeat; null html has no links. An empty table gives
    no rows. Scores are given per unit of the seeds' weight, so they do not
    shrink with the number of hosts.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    parsed = parsed.withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules)).withColumn("given", rule_verdict(F.col("rule"), rules))
    hosts = parsed.filter("host <> ''").groupBy("host").agg(
        (F.count_if(F.col("given") == "allow") / F.count(F.lit(1))).alias("trust"), (F.count_if(F.col("given") == "block") / F.count(F.lit(1))).alias("distrust")
    )
    seeds = saved(spark, hosts.unpivot("host", ["trust", "distrust"], "kind", "weight").filter("weight > 0"), "host-weights").select("kind", "host", "weight")
    scores = spread(spark, seeds, host_links(parsed))
    even = seeds.groupBy("kind").agg(F.sum("weight").alias("n"))
    scaled = scores.join(F.broadcast(even), "kind").withColumn("score", F.col("score") * F.col("n"))  # two rows
    both = scaled.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"), F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"))
    judged = parsed.drop("html").join(both, "host", "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    method = F.when((distrust > 0) & (distrust > threshold * trust), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("given", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
