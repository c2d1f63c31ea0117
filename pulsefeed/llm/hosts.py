"""URL filters by propagation over the link graph, in DataFrame functions only.

Rules allow or block hosts and paths. Hosts that rules allow are trusted seeds
and hosts that rules block are distrusted seeds, by the share of their pages.
Trust flows along links (personalised PageRank); distrust flows against them, to
those who link to blocked hosts. A url takes the verdict of its longest fitting
rule; one that no rule fits is blocked if distrust makes up more than a threshold
of what reached its host, and allowed otherwise.

Rules are a short list, a parameter. A null url or one without a scheme has an
empty host and path, fits no rule and is allowed. Null html has no links. Repeated
pages count as often as they are there. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsefeed.llm.common import keep

ROUNDS = 20
DAMPING = 0.85
THRESHOLD = 0.5
KEEP_EVERY = 5
# Address of a link: the href of an anchor, quoted or not.
HREF = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.substring_index(F.substr(url, F.instr(url, "://") + 3), "/", 1))
    return F.coalesce(F.translate(F.regexp_extract(after, "^[^?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null; of equal ones the first by name."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts; relative links stay on their host."""
    links = pages.select(F.col(host).alias("src"), F.explode(F.regexp_extract_all(html, F.lit(HREF), 1)).alias("href"))
    absolute = F.when(F.startswith("href", F.lit("//")), F.concat(F.lit("x:"), F.col("href"))).otherwise(F.col("href"))
    links = links.filter(F.contains("href", F.lit("//"))).select("src", host_of(absolute).alias("dst"))
    return links.filter("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, start: str, end: str, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, score) after ``rounds`` of personalised PageRank from ``seeds`` (host, seed) along ``start`` -> ``end``."""
    out_of = edges.groupBy(start).agg(F.sum("n").alias("total"))
    flow = keep(edges.join(out_of, start).select(F.col(start).alias("f"), F.col(end).alias("t"), (F.col("n") / F.col("total")).alias("w")), "flow")
    base = F.col("seed") * F.lit(1 - damping)
    scores = seeds.select("host", base.alias("score"))
    if flow.isEmpty():
        return scores
    for k in range(1, rounds + 1):
        moved = flow.join(scores, F.col("f") == F.col("host")).groupBy("t").agg(F.sum(F.col("score") * F.col("w")).alias("got"))
        got = F.coalesce("got", F.lit(0.0)) * F.lit(damping)
        scores = seeds.join(moved, F.col("host") == F.col("t"), "left").select("host", (base + got).alias("score"))
        if k % KEEP_EVERY == 0 or k == rounds:
            scores = keep(scores, "rank")
    return scores


def judge(pages: DataFrame, rules: tuple[Rule, ...], threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parsed.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    share = lambda verdict: F.count_if(F.col("found.verdict") == verdict) / F.count("*")
    counted = ruled.groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    edges = keep(host_links(pages.select(host_of(F.col("url")).alias("host"), "html")), "host-links")
    ends = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct()
    nodes = keep(ends.join(counted, "host", "full").na.fill(0.0, ["allowed", "blocked"]), "hosts")
    trust = propagate(nodes.select("host", F.col("allowed").alias("seed")), edges, "src", "dst")
    distrust = propagate(nodes.select("host", F.col("blocked").alias("seed")), edges, "dst", "src")
    scored = trust.withColumnRenamed("score", "trust").join(distrust.withColumnRenamed("score", "distrust"), "host")
    bad = F.col("distrust") > F.lit(threshold) * (F.col("trust") + F.col("distrust"))
    scored = scored.select(F.col("host").alias("of_host"), F.when(bad & (F.col("host") != ""), "block").otherwise("allow").alias("by_graph"))
    out = ruled.join(scored, F.col("host") == F.col("of_host"), "left")
    return out.select("page_id", "host", "path", F.col("found.name").alias("rule"), F.coalesce("found.verdict", "by_graph").alias("verdict"))
