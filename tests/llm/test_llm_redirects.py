"""Rules against plain code; aliases through links, forms and precedence."""

import random
import re

from obsmart.llm.components import components
from urllib.parse import urljoin

from obsmart.llm.redirects import RULES, judge_urls, page_links, resolved, shortest_form


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def ruled(url):
    host, path = split(url)
    fits = [(len(h) + len(p), h + p, a) for h, p, a in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_rules(spark):
    rng = random.Random(8)
    urls = [None, "", "no host", "http://", "x://net", "x://NET/", "http://a.net?x=/", "http://knet/", "ftp://example.net/en/a#b", "http://u.example.net/en", "http://é.org/fr/"]
    urls += ["http://" + rng.choice(["", "www.", "M.", "a.b."]) + rng.choice(["example.net", "example.com", "x.org", "net", "fr"])
             + rng.choice(["", "/", "/en/", "/de/1", "/fr/x", "?q", "#f"]) for _ in range(150)]
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id bigint, url string, rule string")
    got = {r.page_id: r for r in judge_urls(df).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert (got[i].host, got[i].path) == split(u)
        rule, action = ruled(u)
        assert got[i].rule == rule
        if action:
            assert got[i].verdict == action


def test_decisions_reach_aliases(spark):
    pages = [(1, "http://a.org/x", '<link rel="canonical" href="http://bad.net/x">'), (2, "https://www.a.org/x/?utm_source=q#top", ""),
             (3, "http://b.org/y", '<meta http-equiv="refresh" content="0; url=http://bad.net/y">'),
             (4, "http://example.net/en/ok", '<link href="http://bad.net/y" rel=canonical>'), (5, "http://c.org/z", ""), (6, "http://bad.net/q", None), (7, None, None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(df).collect()}
    assert got[1] == (None, "block") and got[2] == (None, "block")           # alias of an alias
    assert got[3] == (None, "allow")                                          # an explicit allow in its class
    assert got[4] == ("example.net/en/", "allow") and got[5] == (None, "allow") and got[6] == ("net/", "block") and got[7] == (None, "allow")
    assert page_links(df).count() == 3


def test_links_resolve_as_urls_do(spark):
    bases = ["http://a.org", "http://a.org/", "https://a.org/x/y/z.html?q=1#f", "http://a.org/x/y/"]
    links = ["z.html", "../q", "../../../up", "./here", ".", "..", "a/./b/../c/", "/abs/../p", "//b.org/k", "?s=2", "#top", "ftp://c.net/d", "q/r?x=/../y#z", "http://d.org"]
    rows = [(b, x) for b in bases for x in links]
    df = spark.createDataFrame(rows, "url string, link string")
    for r in df.select("url", "link", resolved(df.link, df.url).alias("v")).collect():
        want = urljoin(r.url if r.url != "http://a.org" else "http://a.org/", r.link)
        if r.link == "#top":
            want = re.sub("#.*", "", r.url)
        elif r.link == "?s=2":
            want = re.sub("[?#].*", "", r.url) + r.link
        assert r.v == want, (r.url, r.link)
    odd = spark.createDataFrame([("http://a.org/", "mailto:x@y.z"), ("http://a.org/", "a?b=1&amp;c=2"), ("nothing", "z.html")], "url string, link string")
    assert [r.v for r in odd.select(resolved(odd.link, odd.url).alias("v")).collect()] == [None, "http://a.org/a?b=1&c=2", None]


def test_links_in_any_form(spark):
    forms = {'<link rel="canonical" href="z.html">': "http://a.org/d/z.html", "<LINK href='../q' REL='canonical'>": "http://a.org/q",
             '<meta content="0; url=/r" http-equiv="refresh">': "http://a.org/r", "<meta http-equiv=refresh content='5;URL=http://b.net/'>": "http://b.net/",
             '<meta content="http://c.org/" property="og:url">': "http://c.org/", '<meta name="og:url" content="/o?a=1&amp;b=2">': "http://a.org/o?a=1&b=2",
             '<link rel="stylesheet" href="s.css"><a href="canonical">': None, '<meta http-equiv="refresh" content="30">': None}
    rows = [(i, "http://a.org/d/page", f"<html><head>{x}</head>", e) for i, (x, e) in enumerate(forms.items())]
    for i, url, html, want in rows:
        got = page_links(spark.createDataFrame([(i, url, html)], "page_id bigint, url string, html string")).collect()
        assert [r.v for r in got] == ([want] if want else []), html
    both = '<link rel=canonical href=/one><meta property="og:url" content="/two">'
    assert page_links(spark.createDataFrame([(1, "http://a.org/d", both)], "page_id bigint, url string, html string")).count() == 2


def test_shortest_form(spark):
    df = spark.createDataFrame([("HTTPS://www.A.org/x/index.html?b=1&utm_a=2#f",), ("http://m.a.org/x/?b=1",), ("bad",)], "url string")
    got = [r[0] for r in df.select(shortest_form(df.url)).collect()]
    assert got == ["//a.org/x?b=1", "//a.org/x?b=1", None]


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)] + [(300, 300 + i) for i in range(1, 40)]
    edges += [(None, 4), (7, 7)]
    parent = {}
    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
