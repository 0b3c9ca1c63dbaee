"""URL verdicts against a plain version, with redirects and canonical links."""

import re

from webtide.llm import queries, urlblock

RULES = [(*r,) for r in queries.URL_RULES]


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def rule_of(url, rules):
    host, path = split(url)
    fits = [r for r in rules if host and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: (len(r[0] + r[1]), r[2] == "allow"), default=None)


def brute(pages, edges, rules):
    group = {}

    def root(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        group[root(a)] = root(b)
    acts = {}
    for u in list(group):
        if r := rule_of(u, rules):
            acts.setdefault(root(u), set()).add(r[2])
    out = []
    for page_id, url in pages:
        r = rule_of(url, rules)
        found = acts.get(root(url), set()) if url in group else set()
        method = "block" if found == {"block"} else "allow"
        out.append((page_id, *split(url), r and r[0] + r[1], r[2] if r else method))
    return sorted(out, key=repr)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = urlblock.judge(pages, RULES).collect()
    known = [(r.page_id, r.url) for r in pages.collect()]
    edges = [tuple(r) for r in urlblock.page_edges(pages).collect()]
    assert sorted((tuple(r) for r in got), key=repr) == brute(known, edges, RULES)


def test_aliases(spark):
    link = lambda to: f'<html><head><link href="{to}" rel="canonical"></head>'
    pages = [
        (1, "https://a.org/x", link("https://shop.net/es/1")),  # its target is blocked
        (2, "https://b.org/y", link("https://a.org/x")),
        (3, "https://c.org/z", '<META HTTP-EQUIV=refresh content="0; url=http://b.org/y/">'),
        (4, "https://d.org/1", link("/2")),
        (5, "https://d.org/2", "<p>"),
        (6, "http://E.org/q?utm_source=x#f", ""),
        (7, "https://f.org/", link("https://shop.net/fr/1")),
        (8, "https://g.org/", link("https://f.org/")),
        (9, "https://www.example.com/en/1", link("https://f.org/")),  # allowed by rule: its group is
        (10, None, None),
        (11, "no address", "<p>"),
        (12, "https://shop.net/es/1", None),
        (12, "https://shop.net/es/1", None),
        (13, "x" * 100000 + "://h.net/es/", "<p>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS rule", "2 AS component")
    got = sorted((tuple(r) for r in urlblock.judge(df, RULES, spark.createDataFrame([("https://e.org/q", "https://d.org/2"), ("https://d.org/2", "https://shop.net/fr/9")], "x string, y string")).collect()), key=repr)
    verdict = {r[0]: r[4] for r in got}
    assert verdict == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "block", 7: "allow", 8: "allow", 9: "allow", 10: "allow", 11: "allow", 12: "block", 13: "block"}
    assert len(got) == 14 and ("", "") == next(r[1:3] for r in got if r[0] == 10)
    assert urlblock.judge(df.limit(0), RULES).count() == 0


def test_plain_form(spark):
    rows = {"http://A.com/b/?x=1&utm_source=q&y#z": "https://a.com/b?x=1&y", "https://a.com": "https://a.com", "ftp://a/": "ftp://a", "a": None}
    df = spark.createDataFrame([(k,) for k in rows], "url string")
    assert {r.url: r.p for r in df.select("url", urlblock.plain(df.url).alias("p")).collect()} == rows
