from __future__ import annotations

import random

from shelfcast.llm import url_rules


def slow(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def judged(spark, urls, rules, **more):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_rules.judge(frame, url_rules.rules_from(spark, rules), **more).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}


def test_nested_rules_against_brute_force(spark):
    dice = random.Random(3)
    hosts = ["org", "example.org", "a.example.org", "com", "b.com", "org.com", "example"]
    paths = ["/", "/a", "/a/", "/ab", "/a/b", "/a/b/c", "/b"]
    rules = [(h, p, dice.choice(["allow", "block"])) for h in hosts for p in paths if dice.random() < 0.6]
    urls = [
        f"http://{dice.choice(['', 'x.', 'a.', 'X.Y.'])}{dice.choice(hosts + ['net'])}"
        f"{dice.choice(['', *paths, '/a/b/c/d', '/abc', '?q=/a', '#/a', '/a?b#c'])}"
        for _ in range(400)
    ]
    urls += [None, "", "no scheme", "://", ":///a", "x://.org/a", "http://org", "http://éa.org/\U0010ffff/a", "a://b://c/a"]
    got = judged(spark, urls, rules, urls_per_sweep=7)
    assert got == {i: slow(u, rules) for i, u in enumerate(urls)}
    assert len({g[2] for g in got.values()}) > 15


def test_repeats_nulls_and_clashing_columns(spark):
    rows = [(1, "http://x.org/a", "h", 1)] * 3 + [(None, "http://x.org/a", "h", 1), (2, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, host string, suffix int")
    rules = [("org", "/", "block"), ("org", "/", "allow")]
    got = sorted(map(tuple, url_rules.judge(frame, url_rules.rules_from(spark, rules)).collect()), key=str)
    hit = ("x.org", "/a", "org/", "block")
    assert got == sorted([(1, *hit)] * 3 + [(None, *hit), (2, "", "", None, "allow")], key=str)


def test_empty_tables(spark):
    rules = url_rules.rules_from(spark, [("org", "/", "block")])
    none = spark.createDataFrame([], "page_id long, url string")
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_rules.judge(none, rules).collect() == []
    assert [r.verdict for r in url_rules.judge(one, rules.where("false")).collect()] == ["allow"]


def test_very_long_url(spark):
    url = "http://a.org/" + "x" * 200_000
    assert judged(spark, [url], [("org", "/xx", "block")])[0][2:] == ("org/xx", "block")
