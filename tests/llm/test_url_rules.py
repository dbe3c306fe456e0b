from __future__ import annotations

import re

import pytest

from postgrain.llm.queries import PATTERNS, SITE_RULES
from postgrain.llm.url_rules import Pattern, SiteRule, judge_urls, split_url
from tests.llm.data import with_clashes

URLS = [
    "http://a.example.org/es/x", "https://EXAMPLE.org/en/12?q", "http://b.org/", "http://b.org", "http://notorg/", "x.org/es/",
    None, "", "://", "http://m.example.com/de/1#f", "http://com/fr/", "http://shop.com/cart/1", "http://ads.site.net/x/",
    "http://q.net/a?sessionid=3", "http://q.net/a?xsessionid=3", "http://example.org/en/1", "a://b://c.org/", "http://x.net/a\n/cgi-bin/",
    "http://ex.com/DE/", "http://org/" + "p/" * 20000, "http://org/", "http://org/",
]


def slow(url, rules):
    """Every rule on every URL."""
    host, path, rest = split_url(url)
    sites = [r for r in rules if isinstance(r, SiteRule) and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if sites:
        best = max(sites, key=lambda r: r.weight)
        return host, path, best.name, best.verdict
    found = [p for p in rules if isinstance(p, Pattern) and re.search(p.regex, host + path + rest, re.DOTALL)]
    return host, path, None, max(found, key=lambda p: (p.weight, p.name)).verdict if found else "allow"


@pytest.mark.parametrize("per_pass", [1, 3, 100])
def test_same_as_every_rule_on_every_url(spark, per_pass):
    rules = [*SITE_RULES, *PATTERNS, Pattern("*", "allow")]
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    pages = with_clashes(pages, "verdict", "best", "key", "host", "rule")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, rules, rules_per_pass=per_pass).collect()}
    assert got == {i: slow(u, rules) for i, u in enumerate(URLS)}


def test_no_rules_no_pages_and_repeated_pages(spark):
    pages = spark.createDataFrame([(1, "http://org/"), (1, "http://org/"), (None, None)], "page_id long, url string")
    assert [r["verdict"] for r in judge_urls(pages, []).collect()] == ["allow"] * 3
    assert judge_urls(pages, SITE_RULES).count() == 3
    assert judge_urls(pages.limit(0), SITE_RULES).count() == 0


def test_a_token_that_may_go_on_is_no_index_token():
    assert SiteRule("example.org", "/en/1", "block").tokens() == {"example", "org", "en"}
    assert Pattern("^sessionid=", "block").tokens() == {"sessionid"}
    assert Pattern("*track*", "block").tokens() == set()
