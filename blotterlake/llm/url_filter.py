"""URL judgement by rules and by propagation over the link graph of hosts.

A page's own rule decides where one fits.  Elsewhere its host is judged: trust flows from hosts with allowed pages along
links (personalised PageRank), distrust flows from hosts with blocked pages against the direction of links.  A host's seed is the
share of its pages that a rule allows or blocks.  A host without links passes nothing on.  The host is blocked
if its distrust exceeds its trust by more than ``THRESHOLD``; a host without evidence is allowed.

Pages are reduced to (page_id, host, path) and links to counted pairs of hosts before anything is shuffled by host;
rounds run on host tables alone and are stored, the one before is deleted.  Damping shrinks the sum of all changes by its share
each round, so rounds end by themselves: when no host changes by more than ``TOLERANCE``.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule, has no part in the graph and is allowed; null html
has no links; null and repeated page_ids are rows like others; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from blotterlake.llm.common import drop_stored, materialize

DAMPING = 0.85
THRESHOLD = 0.05
TOLERANCE = 1e-9  # of the largest change of a host in a round
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rules_of_hosts(hosts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """For each host that rules fit: its rules, longest first, then by path.  ``hosts`` holds distinct names."""
    spark = hosts.sparkSession
    schema = "rule_host string, rule struct<size: int, path: string, text: string, verdict: string>"
    listed = spark.createDataFrame([(r.host, (len(r.text), r.path, r.text, r.verdict)) for r in rules], schema)
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = hosts.select("host", F.explode(suffixes).alias("rule_host")).join(listed, "rule_host")
    return fitting.groupBy(F.col("host").alias("of_host")).agg(F.sort_array(F.collect_list("rule"), asc=False).alias("rules"))


def link_pairs(pages: DataFrame) -> DataFrame:
    """(source, target, n): links between different hosts, counted."""
    host, _ = host_and_path(F.col("url"))
    links = F.regexp_extract_all(F.col("html").cast("string"), F.lit(LINK), F.lit(1))
    rows = pages.select(host.alias("source"), F.explode(links).alias("target"))
    rows = rows.select("source", lower_ascii(F.col("target")).alias("target"))
    return rows.where("source != '' and source != target").groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING) -> DataFrame:
    """host, trust and distrust at the fixed point, for every host of the seeds and links.

    ``seeds`` holds distinct hosts with trust_seed and distrust_seed; ``links`` distinct pairs with n.
    """
    out = links.groupBy(F.col("source").alias("s")).agg(F.sum("n").alias("sent"))
    into = links.groupBy(F.col("target").alias("t")).agg(F.sum("n").alias("received"))
    shares = links.join(out, F.col("source") == F.col("s")).join(into, F.col("target") == F.col("t")).select(
        "source", "target", (F.col("n") / F.col("sent")).alias("forward"), (F.col("n") / F.col("received")).alias("backward")
    )
    shares = materialize(shares, "host-links")
    names = shares.select(F.col("source").alias("host")).union(shares.select("target")).distinct()
    start = seeds.join(names, "host", "full").select(
        "host", *[(F.coalesce(c, F.lit(0.0)) * (1 - damping)).alias(c) for c in ("trust_seed", "distrust_seed")]
    )
    start = materialize(start, "host-seeds")
    before, ranks = None, start.select("host", F.col("trust_seed").alias("trust"), F.col("distrust_seed").alias("distrust"))
    if not 0 <= damping < 1:
        raise ValueError(f"damping {damping} is not in [0, 1)")
    while True:
        trust = ranks.join(shares, F.col("host") == F.col("source")).select(
            F.col("target").alias("to"), (F.col("trust") * F.col("forward")).alias("trust"), F.lit(0.0).alias("distrust")
        )
        distrust = ranks.join(shares, F.col("host") == F.col("target")).select(
            F.col("source").alias("to"), F.lit(0.0).alias("trust"), (F.col("distrust") * F.col("backward")).alias("distrust")
        )
        given = trust.union(distrust).groupBy("to").agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d"))
        old = ranks.select(F.col("host").alias("old_host"), F.col("trust").alias("old_t"), F.col("distrust").alias("old_d"))
        new = start.join(given, F.col("host") == F.col("to"), "left").join(old, F.col("host") == F.col("old_host")).select(
            "host", (F.col("trust_seed") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
            (F.col("distrust_seed") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"), "old_t", "old_d",
        )
        new = materialize(new, "host-ranks")
        change = new.agg(F.max(F.greatest(F.abs(F.col("trust") - F.col("old_t")), F.abs(F.col("distrust") - F.col("old_d"))))).first()[0]
        if before is not None:
            drop_stored(before)
        before, ranks = new, new.select("host", "trust", "distrust")
        if (change or 0.0) <= TOLERANCE:
            return ranks


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, *, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, the longest fitting rule, verdict, and the host's trust and distrust."""
    host, path = host_and_path(F.col("url").cast("string"))
    slim = materialize(pages.select("page_id", host.alias("host"), path.alias("path")), "page-hosts")
    names = slim.where("host != ''").select("host").distinct()
    of_host = materialize(rules_of_hosts(names, rules), "host-rules")
    best = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["path"])), 0)
    ruled = slim.join(of_host, F.col("host") == F.col("of_host"), "left").select("page_id", "host", "path", best.alias("rule"))
    share = lambda verdict: (F.count_if(F.col("rule.verdict") == verdict) / F.count(F.lit(1)))
    seeds = ruled.where("host != ''").groupBy("host").agg(share("allow").alias("trust_seed"), share("block").alias("distrust_seed"))
    links = link_pairs(pages.select(F.col("url").cast("string").alias("url"), "html"))
    ranks = propagate(seeds, links, damping).withColumnRenamed("host", "rank_host")
    by_host = F.when(F.col("distrust") - F.col("trust") > threshold, "block").otherwise("allow")
    return ruled.join(ranks, F.col("host") == F.col("rank_host"), "left").select(
        "page_id", "host", "path", F.col("rule.text").alias("rule"), F.coalesce("rule.verdict", by_host).alias("verdict"), "trust", "distrust"
    )
