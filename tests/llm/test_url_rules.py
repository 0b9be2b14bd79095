from __future__ import annotations

import random

from parcella.llm import url_rules
from parcella.llm.queries import URL_RULES


def judged(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [
        (len(h + p), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, default))
    return host, path, best[1], best[2]


def check(spark, urls, rules):
    pages = spark.createDataFrame(
        [(i, u, "k", 1) for i, u in enumerate(urls)], "page_id long, url string, key string, kind int"
    )
    table = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, table).collect()}
    assert got == {i: judged(u, rules) for i, u in enumerate(urls)}


def test_nested_rules(spark):
    urls = [
        "http://a.example.com/en/1", "http://WWW.Example.com/en/1?x#y", "https://x.www.example.com/en/", "http://example.com",
        "http://example.com/fr/", "http://b.net/es/1", "http://net/fr/2", "http://xnet/fr/2", "http://b.net/en", None, "",
        "no scheme", "://", "http://", "http:///path", "http://com./x", "http://É.com/en/", "a://b://c/d", "http://.com/",
        "http://h.com/" + "p" * 100_000, "http://a.example.com/en/1",
    ]
    check(spark, urls, URL_RULES)


def test_random_rules_and_hosts(spark):
    r = random.Random(5)

    def host(most):
        return ".".join(r.choice(["a", "b", "ab", "é", "x-y"]) for _ in range(r.randint(1, most)))

    rules = {(host(3), r.choice(["", "/", "/a", "/a/b", "/ab"])): r.choice(["allow", "block"]) for _ in range(40)}
    urls = ["http://" + host(5) + r.choice(["", "/", "/a/b/c", "/abc", "?q"]) for _ in range(600)]
    check(spark, urls * 2, [(h, p, v) for (h, p), v in rules.items()])


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [r.verdict for r in url_rules.judge(pages, none).collect()] == ["allow"]
    some = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    assert url_rules.judge(pages.limit(0), some).count() == 0
