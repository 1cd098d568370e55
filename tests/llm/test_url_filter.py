import pytest

from cartograph.llm.url_filter import RULES, SITE_RULES, judge, site_rule
from tests.llm.helpers import stored

URLS = [
    (1, "https://a.example.org/es/5"), (2, "http://EXAMPLE.org/en/176?x=1"), (3, "http://example.org/en/2"),
    (4, "http://x.com/fr/1#t"), (5, "http://x.com/de/1"), (6, "http://notorg/"), (7, "http://org/"), (8, "http://a.org"),
    (9, None), (10, ""), (11, "no scheme.org/es/"), (12, "http://spam-farm.example.net/en/1"), (13, "http://a.cheap-pills.example.com/fr/2"),
    (14, "http://a.org?/x"), (15, "x://badexample.org/es/1"), (16, "http://example.org.evil.net/es/"), (17, "a://b://example.org/es/"),
    (18, "http://ExAmPlE.ORG/ES/1"), (18, "http://ExAmPlE.ORG/ES/1"), (None, "http://x.com/de"), (19, "http://x.com/" + "d" * 100_000),
    (20, "http://x.example.org/en/1"), (21, "http://com/de/?q"),
]


def brute(url):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    path = tail[:end]
    fits = []
    for action, h, p in (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
                         ("allow", "com", "/fr/"), ("block", "com", "/de/")):
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), h + p, action))
    if fits:
        _, name, action = max(fits)
        return host, path, name, action
    spam = any(w in host.split(".") for w in ("spam-farm", "cheap-pills"))
    return host, path, None, "block" if spam else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    return stored(spark.createDataFrame([(i, u, "<html>", "clash", "clash") for i, u in URLS],
                                        "page_id long, url string, html string, host string, rule string"))


def test_against_brute_force(spark, pages):
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge(pages).collect()), key=repr)
    assert got == sorted(((i, *brute(u)) for i, u in URLS), key=repr)


def test_only_candidates_run(spark, pages):
    tried = {r.page_id: r.n_tried for r in judge(pages).collect()}
    assert tried[9] == 0 and tried[6] <= 1
    assert max(tried.values()) < len(RULES)


def test_rules_without_literals_run_everywhere(spark, pages):
    rule = site_rule("block", "net/")
    bare = type(rule)("any", "block", r".*evil", ())
    got = {r.page_id: r.verdict for r in judge(pages, [bare]).collect()}
    assert got[16] == "block" and got[1] == "allow"


def test_partial_tokens_are_not_indexed():
    assert "1" not in SITE_RULES[2].tokens and "en" in SITE_RULES[2].tokens


def test_empty_table_and_no_rules(spark, pages):
    assert judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in judge(pages, []).collect()} == {"allow"}


def test_html_is_not_read(spark, pages):
    assert "html" not in judge(pages)._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1][:80]
