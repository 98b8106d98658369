"""URL filters: rules for hosts and paths, and a judgement of the other hosts by links.

Trust starts at the hosts that rules allow and follows links; distrust starts at the hosts
that rules block and goes against links, as those who link to blocked hosts are suspect.
Both are personalised PageRank over the links between hosts: a host hands a share of its
score on, split by the number of links, and the rest returns to the seeds. A host without a
rule is blocked if its distrust is larger than its trust.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
ROUNDS = 20  # of propagate by itself; hosts are judged by scores within TOLERANCE
TOLERANCE = 1e-6  # ends the rounds once all scores together change by less
GUARD = 200  # rounds that are never needed: changes shrink by DAMPING a round, to TOLERANCE in some 95

# -- fixed values: the rules, longest first where several fit --
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule whose host is this one or a domain above it and whose path begins
    this one; null if there is none."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        out = F.when(fits, rule).otherwise(out)
    return out


def rule_verdict(rule: Column, rules: dict[str, str]) -> Column:
    return reduce(lambda out, r: F.when(rule == r, rules[r]).otherwise(out), rules, F.lit(None).cast("string"))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links from host to host in the pages' html (columns host, html).

    Links within a host, and those of or to nameless hosts, say nothing and are left out.
    """
    pattern = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
    found = F.regexp_extract_all("html", F.lit(pattern), 1)
    links = pages.select(F.col("host").alias("src"), F.explode(found).alias("dst")).withColumn("dst", F.translate("dst", UPPER, LOWER))
    return links.where("src != '' and src != dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(links: DataFrame, seeds: DataFrame, rounds: int | None = ROUNDS) -> DataFrame:
    """(kind, host, score) from seeds of the same form, whose scores sum to 1 per kind.

    Scores of kind ``trust`` follow links, those of kind ``distrust`` go against them. What a
    host without links would hand on returns to the seeds. Without ``rounds`` it goes on until
    scores change by less than TOLERANCE.

    The state is the score of each host that has one or has links to hand it on. What is handed
    on follows from the scores of hosts with links, so a round is one join with the links and
    one sum by host of what arrives, what returns to the seeds and the old score. Each state is
    checkpointed: no plan grows, and only four numbers reach the driver.
    """
    forward = links.select(F.lit("trust").alias("kind"), "src", "dst", "n")
    backward = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    edges = forward.unionByName(backward)
    out = edges.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    edges = cut_lineage(edges.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("all")).alias("part")))
    seeds = cut_lineage(seeds.select("kind", "host", F.col("score").alias("seed")))
    scores = seeds.select("kind", "host", F.col("seed").alias("score"))
    if edges.isEmpty():
        return scores

    def rows(df: DataFrame, host: str, score: Column, old: Column, linked: Column) -> DataFrame:
        return df.select("kind", F.col(host).alias("host"), score.alias("score"), old.alias("old"), linked.alias("linked"))

    def by_host(parts: list[DataFrame]) -> DataFrame:
        sums = reduce(DataFrame.unionAll, parts).groupBy("kind", "host")
        return cut_lineage(sums.agg(F.sum("score").alias("score"), F.sum("old").alias("old"), F.bool_or("linked").alias("linked")))

    none, no, yes = F.lit(0.0), F.lit(False), F.lit(True)
    state = by_host([rows(seeds, "host", F.col("seed"), none, no), rows(edges.select("kind", "host").distinct(), "host", none, none, yes)])
    for i in range(GUARD if rounds is None else rounds):
        linked = F.sum(F.when(F.col("linked"), F.col("score")).otherwise(0.0))
        sums = state.groupBy("kind").agg(linked.alias("linked"), F.sum(F.abs(F.col("score") - F.col("old"))).alias("change")).collect()
        if rounds is None and i and sum(r.change for r in sums) < TOLERANCE:
            break
        back = reduce(lambda c, r: c.when(F.col("kind") == r.kind, 1 - DAMPING * r.linked), sums, F.when(F.lit(False), 1.0))
        moved = state.where("linked and score > 0").select("kind", "host", "score").join(edges, ["kind", "host"])
        state = by_host([
            rows(moved, "dst", F.col("score") * F.col("part") * DAMPING, none, no),
            rows(seeds, "host", F.col("seed") * back, none, no),
            rows(state, "host", none, F.col("score"), F.col("linked")),
        ])
    else:
        if rounds is None:
            raise RuntimeError(f"scores of hosts still change after {GUARD} rounds")
    return state.where("score > 0").select("kind", "host", "score")


def judge_hosts(judged: DataFrame, links: DataFrame) -> DataFrame:
    """(host, verdict) of hosts that trust or distrust reaches; others are allowed.

    ``judged`` has the host and the verdict of the rules of each page, null without a rule.
    A host is a seed of either kind as often as its pages are allowed or blocked.
    """
    counts = judged.where("verdict is not null and host != ''").groupBy(
        F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host"
    ).agg(F.count("*").alias("n"))
    counts = cut_lineage(counts)
    total = counts.groupBy("kind").agg(F.sum("n").alias("all"))  # one row per kind
    seeds = counts.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("score"))
    scores = propagate(links, seeds, rounds=None)
    score = {k: F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)) for k in ("trust", "distrust")}
    hosts = scores.groupBy("host").agg(score["trust"].alias("trust"), score["distrust"].alias("distrust"))
    return hosts.select("host", F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow").alias("verdict"))


def filter_urls(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of each row.

    Null urls and urls without :// have an empty host and path, fit no rule and are allowed.
    Null html has no links. Repeated rows are judged alike, and count as pages of their host.
    Other columns are ignored.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    judged = rows.select("page_id", "host", "path", "rule", rule_verdict(F.col("rule"), rules).alias("verdict"))
    hosts = judge_hosts(judged.select("host", "verdict"), host_links(rows.select("host", "html")))
    blocked = hosts.where("verdict = 'block'").select("host", F.col("verdict").alias("by_links"))
    return judged.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "by_links", F.lit("allow")).alias("verdict")
    )
