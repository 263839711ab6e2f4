from __future__ import annotations

import random

import pytest

from tallyloom.llm import url_filter as op

URLS = [
    None, "", "no scheme", "http://", "HTTP://Blog.Example.NET/en/1?x#y", "http://example.net/de/1",
    "http://notexample.net/en/", "http://a.example.com/de/", "http://example.com/De/x", "x://org/fr/",
    "http://org", "http://net?/en/", "a://b://example.net/en/", "http://fr.org/fr/a\nb", "http://net/",
    "http://.net/", "http://net./", "http://example.net:80/en/", "http://x.fr.org/fr",
]


def brute(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        ends = [rest.find(c) for c in "/?#" if c in rest]
        host, tail = rest[: min(ends, default=len(rest))], rest[min(ends, default=len(rest)) :]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        (len(h + p), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def pages(spark, urls):
    rows = [(i, u, "h", "r", "v") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string, verdict string")


def judged(spark, urls, rules):
    out = op.judged(pages(spark, urls), op.rule_table(spark, rules)).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}


def test_given_rules(spark):
    want = {i: brute(u, op.RULES) for i, u in enumerate(URLS)}
    assert judged(spark, URLS, op.RULES) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_random_nested_rules(spark, seed):
    draw = random.Random(seed)
    labels = ["a", "b", "ab", "a-b", "z"]
    host = lambda n: ".".join(draw.choice(labels) for _ in range(draw.randint(1, n)))
    path = lambda: "/" + "/".join(draw.choice("xy") for _ in range(draw.randint(0, 2)))
    rules = sorted({(host(3), path()): draw.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{host(5)}{path()}" for _ in range(300)] + ["http://a.b/x"] * 50
    want = {i: brute(u, rules) for i, u in enumerate(urls)}
    assert judged(spark, urls, rules) == want


def test_no_rows_and_no_rules(spark):
    assert judged(spark, [], op.RULES) == {}
    assert judged(spark, ["http://net/"], []) == {0: ("net", "/", None, "allow")}
