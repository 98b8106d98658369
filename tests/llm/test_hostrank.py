"""URL parts, rules and scores against plain statements."""

import random
import time
from collections import defaultdict

import pytest

from tickertide.llm import hostrank
from tickertide.llm.hostrank import DAMPING, RULES, filter_urls, propagate

URLS = [
    "http://Blog.Example.ORG/es/1?x#y", "https://example.org/es", "https://example.org/en/12", "https://aexample.org/en/1", "http://x.com/fr/a",
    "http://x.com/de/a://b", "http://com/fr/", "x.org/", None, "", "a://b://c/d", "http://x.org", "HTTP://X.COM#/fr/", "http://É.com/FR/", "http://x.com/fr",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    i = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, rest = rest[:i], rest[i:]
    i = next((i for i, c in enumerate(rest) if c in "?#"), len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:i]


def rule(host, path):
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def test_parts_and_rules(spark):
    table = spark.createDataFrame([(i, u, None, "h") for i, u in enumerate(URLS)] + [(0, URLS[0], None, "h")], "page_id bigint, url string, html string, host string")
    rows = filter_urls(table).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path = parts(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule(host, path))
        if r.rule:
            assert r.verdict == RULES[r.rule]
    assert filter_urls(table.limit(0)).count() == 0


def plain_rank(edges, seeds, rounds=20):
    out = defaultdict(float)
    for (a, _), n in edges.items():
        out[a] += n
    score = dict(seeds)
    for _ in range(rounds):
        moved = defaultdict(float)
        for (a, b), n in edges.items():
            moved[b] += DAMPING * score.get(a, 0) * n / out[a]
        rest = 1 - sum(moved.values())
        score = {v: moved.get(v, 0) + rest * seeds.get(v, 0) for v in {*moved, *seeds}}
    return score


def test_scores(spark):
    edges = {("a", "b"): 3, ("b", "c"): 1, ("c", "a"): 2, ("a", "d"): 1, ("e", "d"): 5, ("f", "e"): 1}
    links = spark.createDataFrame([(*k, v) for k, v in edges.items()], "src string, dst string, n bigint")
    seeds = spark.createDataFrame([("trust", "a", 0.75), ("trust", "x", 0.25), ("distrust", "d", 1.0)], "kind string, host string, score double")
    got = {(r.kind, r.host): r.score for r in propagate(links, seeds).collect()}
    want = {("trust", h): s for h, s in plain_rank(edges, {"a": 0.75, "x": 0.25}).items()}
    back = {(b, a): n for (a, b), n in edges.items()}
    want |= {("distrust", h): s for h, s in plain_rank(back, {"d": 1.0}).items()}
    assert got == pytest.approx({k: s for k, s in want.items() if s}, abs=1e-5)


def test_scores_that_keep_still(spark):
    """To TOLERANCE, over thirty links with circles, within a minute."""
    rng = random.Random(5)
    edges = {(f"h{a}", f"h{b}"): n for a, b, n in [(rng.randrange(12), rng.randrange(12), 1 + rng.randrange(3)) for _ in range(34)] if a != b}
    links = spark.createDataFrame([(*k, v) for k, v in edges.items()], "src string, dst string, n bigint")
    seeds = spark.createDataFrame([("trust", "h0", 0.5), ("trust", "h5", 0.5), ("distrust", "h3", 1.0)], "kind string, host string, score double")
    begin = time.time()
    got = {(r.kind, r.host): r.score for r in propagate(links, seeds, rounds=None).collect()}
    assert time.time() - begin < 60
    want = {("trust", h): s for h, s in plain_rank(edges, {"h0": 0.5, "h5": 0.5}, 300).items()}
    back = {(b, a): n for (a, b), n in edges.items()}
    want |= {("distrust", h): s for h, s in plain_rank(back, {"h3": 1.0}, 300).items()}
    assert got == pytest.approx({k: s for k, s in want.items() if s}, abs=1e-5)


def test_links_decide_hosts_without_rule(spark):
    pages = [
        (1, "http://good.org/x", '<a href="http://friend.net/1">f</a> <A HREF=//Other.net/>o</A> <a href="/self">s</a>'),
        (2, "http://bad.com/de/1", "nothing"),
        (3, "http://shady.net/", '<a href="https://bad.com/de/2">b</a><a href=\'http://bad.com/de/3\'>b</a>'),
        (4, "http://friend.net/", "x"), (5, "http://other.net/", "x"), (6, "http://alone.net/", None), (7, "http://bad.com/en/", "x"),
    ]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in filter_urls(table).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block"}


def test_hosts_far_from_their_seeds(spark, monkeypatch):
    monkeypatch.setattr(hostrank, "TOLERANCE", 0.01)  # some 32 rounds, where 20 do not reach the last hosts
    # 24 links lead from h24 to the blocked host, through pages that no rule fits.
    pages = [(0, "http://bad.com/de/1", "x")] + [(i, f"http://h{i}.net/", f"<a href='http://{f'h{i - 1}.net' if i > 1 else 'bad.com'}/'>n</a>") for i in range(1, 25)]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        rows = filter_urls(table).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.page_id for r in rows if r.verdict == "block"} == set(range(25))
