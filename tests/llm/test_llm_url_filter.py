"""URL filter: the automaton against regular expressions, and rules against a plain reading of them."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import url_filter
from tidemark.llm.url_filter import GlobAutomaton, Rule


def expression(glob):
    parts = {"**": ".*", "*": "[^/?]*", "?": "[^/?]"}
    return re.compile("".join(parts.get(p, re.escape(p)) for p in re.findall(r"\*\*|.", glob, re.S)), re.S)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab/.*?", max_size=30), min_size=1, max_size=12), st.lists(st.text("ab/.?\n", max_size=40), max_size=8))
def test_automaton_matches_as_expressions_do(globs, texts):
    found = GlobAutomaton(tuple(globs)).match(texts)
    assert found.tolist() == [[bool(expression(g).fullmatch(t)) for g in globs] for t in texts]


def plain(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None
    rest = re.split("[?#]", url[at + 3 :])[0]
    host, slash, path = rest.partition("/")
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


URLS = [
    None, "", "no url", "http://", "http://net", "http://net/", "https://A.Example.NET/en/x?q=/fr/", "https://example.net/en", "ftp://example.net/EN/",
    "http://x.org/fr/1", "http://xorg/fr/1", "http://evil.com/x.net/", "http://evil.com?x=.net/", "http://example.com/de/#a", "http://notexample.com/de/",
    "http://É.net:80/ü", "http://a.net#/", "a://b://c.net/", "http://free-bets.example.com/fr", "http://ads-track.example.org/en", "http://cheap-pills.example.com",
    "http://example.com/" + "p/" * 20_000,
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "old") for i, u in enumerate(URLS * 2)], "page_id bigint, url string, HOST string, verdict string")
    rows = {r.page_id: r for r in url_filter.filter_urls(pages).collect()}
    assert len(rows) == 2 * len(URLS)
    for i, u in enumerate(URLS * 2):
        host, path, rule = plain(u)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule.name if rule else None), u
        if rule:
            assert rows[i].verdict == rule.action
    assert [rows[i].verdict for i in range(len(URLS) - 4, len(URLS))] == ["block", "block", "block", "allow"]


def test_more_rules_than_bits_of_a_word_and_no_rules(spark):
    rules = tuple(Rule("block", f"h{i}.example", "/") for i in range(60)) + (Rule("allow", "h7.example", "/a"),)
    pages = spark.createDataFrame([(f"http://x.h{i}.example/a{i}",) for i in range(60)], "url string")
    out = {r.rule: r.verdict for r in url_filter.filter_urls(pages, rules=rules, blocked=()).collect()}
    assert len(out) == 60 and out["h7.example/a"] == "allow" and out["h8.example/"] == "block"
    assert {r.verdict for r in url_filter.filter_urls(pages, rules=(), blocked=(), default="review").collect()} == {"review"}
    assert url_filter.filter_urls(pages.limit(0)).collect() == []
