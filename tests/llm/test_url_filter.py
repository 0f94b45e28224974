from __future__ import annotations

import itertools

import pytest

from corpuslab.llm import url_filter
from corpuslab.llm.url_filter import UrlTrie, filter_urls

ALLOW, BLOCK = ["org/", "com/fr/"], ["example.org/es/", "example.org/en/1", "com/de/"]
URLS = [
    None, "", "example.org/es/", "http://Example.ORG/es/x?y#z", "https://a.b.example.org/es/", "http://example.org/es",
    "http://example.org/en/1", "http://example.org/en/123/4", "http://example.org/en/2", "http://notexample.org/es/",
    "http://example.org", "http://example.org?x=/es/", "http://x.com/fr/", "http://x.com/fr", "http://x.com/de/a", "ftp://com/de/",
    "http://x.com:80/de/", "http://org/", "http://org./", "a://b://c.org/x", "http://ÄX.org/é", "://x.org/", "http:///es/",
    "http://example.org/es//a", "http://example.org/en/1\n", "http://x.org/" + "a/" * 50_000,
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    best = None
    for verdict, rules in (("allow", ALLOW), ("block", BLOCK)):
        for rule in rules:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
                best = (rule, verdict)
    return host, path, best and best[0], best[1] if best else "allow"


def frame(spark, urls):
    return spark.createDataFrame(
        [(k, u, "h", "p") for k, u in enumerate(urls)], "page_id long, url string, host string, path string"
    )


def test_against_brute_force(spark):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(frame(spark, URLS), ALLOW, BLOCK).collect()}
    assert got == {k: brute(u) for k, u in enumerate(URLS)}


def test_all_small_urls(spark):
    hosts = ["org", "example.org", "a.example.org", "com", "b.com", "net"]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12/", "/fr/", "/de/", "/de"]
    urls = [f"http://{h}{p}" for h, p in itertools.product(hosts, paths)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(frame(spark, urls), ALLOW, BLOCK).collect()}
    assert got == {k: brute(u) for k, u in enumerate(urls)}


def test_longest_match_wins_and_block_wins_ties():
    trie = UrlTrie(["a.org/x/y", "org/"], ["a.org/x/", "a.org/x/y"])
    assert trie.match("www.a.org", "/x/yz") == ("a.org/x/y", "block")
    assert trie.match("www.a.org", "/x/z") == ("a.org/x/", "block")
    assert trie.match("a.org", "/x") == ("org/", "allow")
    assert trie.match("org.a", "/") is None and trie.match("", "") is None


def test_default_verdict_repeated_and_empty_rows(spark):
    pages = frame(spark, ["http://x.net/", "http://x.net/"]).union(frame(spark, ["http://x.net/"]))
    assert [r.verdict for r in filter_urls(pages, ALLOW, BLOCK, default="block").collect()] == ["block"] * 3
    assert filter_urls(frame(spark, []), ALLOW, BLOCK).collect() == []


def test_large_rule_sets_are_refused(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_RULE_BYTES", 10)
    with pytest.raises(ValueError, match="rules take"):
        filter_urls(frame(spark, []), ALLOW, BLOCK)
