"""URL verdicts from rules, and for pages without a rule from the link graph of hosts.

Rules give seeds: a host is trusted by the share of its pages that rules allow, and distrusted by the
share that rules block. Trust follows links (personalised PageRank from the trusted seeds); distrust
follows them backwards, to the hosts that link to blocked ones. Both run over host edges as DataFrame
rounds: each round pushes only what the last one added, until what is left is negligible. What hosts
without links hold would return to the seeds; that scales all scores alike, so it is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, text_of, without
from tidemark.session import cut

DAMPING = 0.85
LEFT = 1e-3  # share of the seeds' mass that may remain unpushed
UNROLLED = 4  # rounds between written tables
MARGIN = 0.5  # a host is blocked where distrust exceeds trust by this share of a full seed
LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without one."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(docs: DataFrame, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """``(verdict, rule)`` pairs such as ``("block", "example.com/en/")`` as a table."""
    return docs.sparkSession.createDataFrame(list(rules), "verdict string, rule string")


def with_rules(parsed: DataFrame, rules: DataFrame) -> DataFrame:
    """``parsed`` with the longest fitting ``rule`` and its verdict, NULL where none fits.

    Every distinct host is unfolded into itself and its parents and joined with the rules' hosts, so any
    number of rules costs one join; the pages are then joined once, by host.
    """
    cut_at = F.locate("/", F.col("rule"))
    split = rules.select(
        "rule",
        "verdict",
        F.expr("substring(rule, 1, locate('/', rule) - 1)").alias("__suffix"),
        F.expr("substring(rule, locate('/', rule))").alias("prefix"),
    ).filter(cut_at > 0)
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    fitting = (
        parsed.select("host").distinct().withColumn("__suffix", F.explode(parents))
        .join(split, "__suffix")
        .groupBy("host")
        .agg(F.collect_set(F.struct(F.length("rule").alias("size"), "rule", "prefix", "verdict")).alias("__rules"))
    )
    fit = F.filter("__rules", lambda r: F.startswith(F.col("path"), r["prefix"]))
    best = F.array_max(fit)
    plain = [F.col(f"`{c}`") for c in parsed.columns]
    return parsed.join(cut(fitting), "host", "left").select(*plain, best["rule"].alias("rule"), best["verdict"].alias("__ruled"))


def host_edges(linked: DataFrame) -> DataFrame:
    """``(way, from, to, weight)``: links for trust, reversed links for distrust, each summing to 1 per start."""
    counted = cut(
        linked.select("host", F.explode("links").alias("target"))
        .filter((F.col("host") != F.col("target")) & (F.col("host") != ""))
        .groupBy("host", "target")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def one_way(way: str, start: str, end: str) -> DataFrame:
        total = counted.groupBy(start).agg(F.sum("n").alias("all"))
        weight = (F.col("n") / F.col("all")).alias("weight")
        return counted.join(total, start).select(F.lit(way).alias("way"), F.col(start).alias("from"), F.col(end).alias("to"), weight)

    return cut(one_way("trust", "host", "target").unionByName(one_way("distrust", "target", "host")))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, left: float = LEFT) -> DataFrame:
    """``(way, host, score)``: personalised PageRank of both ways from ``seeds (way, host, share)``, times the seeds' sum."""
    begin = (1 - damping) * F.col("share")
    state = cut(seeds.filter("share > 0").select("way", "host", begin.alias("score"), begin.alias("added")))
    rounds = math.ceil(math.log(left) / math.log(damping))
    for done in range(0, rounds, UNROLLED):
        if state.join(edges, (edges["way"] == state["way"]) & (edges["from"] == state["host"]), "left_semi").filter("added > 0").isEmpty():
            break
        for _ in range(min(UNROLLED, rounds - done)):
            moving = state.filter("added > 0").select("way", F.col("host").alias("from"), "added")
            pushed = edges.join(moving, ["way", "from"]).select(
                "way", F.col("to").alias("host"), (F.col("added") * F.col("weight") * damping).alias("added")
            )
            both = state.select("way", "host", "score", F.lit(0.0).alias("added")).unionByName(
                pushed.select("way", "host", F.col("added").alias("score"), "added")
            )
            state = both.groupBy("way", "host").agg(F.sum("score").alias("score"), F.sum("added").alias("added"))
        state = cut(state)
    return state.select("way", "host", "score")


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str]],
    url: str = "url",
    html: str = "html",
    id_column: str = "page_id",
    margin: float = MARGIN,
) -> DataFrame:
    """Every page with ``(id, host, path, rule, verdict, trust, distrust)``.

    A rule decides where one fits; else the page takes the verdict of its host: block where distrust exceeds
    trust by ``margin`` of a full seed, allow otherwise, so hosts that nothing is known of are allowed.
    NULL urls and urls without ``://`` have an empty host, which has no links and no seed. NULL html has no links.
    Repeated pages and repeated urls are judged alike, a rule given twice counts once, and an empty table
    gives an empty result.
    """
    link_hosts = F.array_distinct(F.transform(F.regexp_extract_all(text_of(html), F.lit(LINK), F.lit(1)), ascii_lower))
    parsed = cut(
        pages.select(
            F.col(f"`{id_column}`").alias("__id"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"), link_hosts.alias("links")
        )
    )
    ruled = cut(with_rules(without(parsed, "links"), rule_table(pages, rules)))
    share = F.avg(F.when(F.col("__ruled") == "allow", 1.0).otherwise(0.0)), F.avg(F.when(F.col("__ruled") == "block", 1.0).otherwise(0.0))
    shares = ruled.filter("host <> ''").groupBy("host").agg(share[0].alias("trust"), share[1].alias("distrust"))
    seeds = shares.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (way, share)"))
    scores = propagate(seeds, host_edges(parsed))
    by_host = cut(
        scores.groupBy("host").agg(
            F.sum(F.when(F.col("way") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
            F.sum(F.when(F.col("way") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
        )
    )
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    over = distrust - trust > margin * (1 - DAMPING)
    verdict = F.coalesce("__ruled", F.when(over, "block").otherwise("allow"))
    return ruled.join(by_host, "host", "left").select(
        F.col("__id").alias(id_column), "host", "path", "rule", verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust")
    )
