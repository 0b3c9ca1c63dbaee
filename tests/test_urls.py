"""Scalar vectors for URL functions."""

import urllib.parse

import pytest
from pyspark.sql import functions as F

from webtide.functions import urls


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_url(spark):
    cases = {
        "https://e.com/a/#top": "https://e.com/a/",
        "https://e.com/a//": "https://e.com/a",
        "https://e.com/a?b=/": "https://e.com/a?b=",
        "  https://e.com/ \n": "https://e.com",
        " 　https://e.com/x\x85": "https://e.com/x",
        "/////": "",
        "a\n/": "a\n",
        "": "",
    }
    assert run(spark, urls.clean_url, cases) == list(cases.values())
    assert [c.strip().rstrip("/").split("#")[0] for c in cases] == list(cases.values())


def test_with_protocol(spark):
    cases = {
        "e.com": "https://e.com",
        " http://e.com ": "http://e.com",
        "HTTP://e.com": "https://HTTP://e.com",
        "https://e.com": "https://e.com",
        "ftp://e.com": "https://ftp://e.com",
    }
    assert run(spark, urls.with_protocol, cases) == list(cases.values())


def test_normalize_domain(spark):
    cases = {
        "https://www.Example.COM/path": "example.com",
        "www.www.e.com": "www.e.com",
        "https://u:p@E.com:8080/x": "u:p@e.com:8080",
        "e.com/x": "e.com/x",
        "HTTP://WWW.E.com?x": "e.com",
        "": "",
    }
    assert run(spark, urls.normalize_domain, cases) == list(cases.values())


def test_validate_url(spark):
    cases = {
        "e.com": True,
        "https://e.com": True,
        "https://sub.e.co.uk/a?b#c": True,
        "https://e.com:80/": False,
        "https://u@e.com/": False,
        "localhost": False,
        "127.0.0.1": False,
        "e.com?x": False,
        "HTTP://e.com": False,
        "e.com/a b": False,
        "e.com/a b": False,
        "E.COM/x": True,
        " e.com ": True,
        "e.c": False,
        "": False,
        "e.Kom": True,
    }
    assert run(spark, urls.validate_url, cases) == list(cases.values())


PARTS = [
    "https://e.com/p/q;x",
    "https://e.com/p;y/q;x;z?a=b;c#f?g",
    "HTTP://E.com",
    "mailto:x@y;z",
    "/a/b?c",
    "//h/p",
    "https://e.com?q=1",
    "https://e.com#f",
    "1http://x/y",
    "a b c",
    " \x01https://e.com/%zz x",
    "ht\ntps://e.c\tom/x",
    "x:y:z",
    ":",
    "",
    "http:///p",
]


def test_url_parts(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(PARTS)], "i int, v string")
    got = [
        tuple(r.p) for r in df.select("i", urls.url_struct(F.col("v")).alias("p")).orderBy("i").collect()
    ]
    want = []
    for v in PARTS:
        p = urllib.parse.urlparse(v)
        want.append((p.scheme, p.netloc, p.path, p.query))
    assert got == want


JOINS = [
    ("https://e.com/a/b", "x//y/../z", "https://e.com/a/x/z"),
    ("https://e.com/a/b", "/x//y", "https://e.com/x//y"),
    ("https://e.com", "about", "https://e.com/about"),
    ("https://e.com", "?q=1", "https://e.com?q=1"),
    ("https://e.com/a/b?z=1", "?q=1", "https://e.com/a/b?q=1"),
    ("https://e.com/a/b", "//cdn.e.com/x", "https://cdn.e.com/x"),
    ("https://e.com/a/b", "../../../c", "https://e.com/c"),
    ("https://e.com/a/b/", "..", "https://e.com/a/"),
    ("https://e.com/a/b", "mailto:x@y", "mailto:x@y"),
    ("https://e.com/a/b", "HTTPS://E.com/X", "https://E.com/X"),
    ("https://e.com/a/b", "HTTP://E.com/X", "HTTP://E.com/X"),
    ("https://e.com/a/b", " c ", "https://e.com/a/c "),
]


def test_resolve(spark):
    hrefs = [
        ".", "./", "..", "../", "../..", "x", "x/", "x/.", "x/..", "./x", "/", "//", "///a",
        "/./a", "/../a", "/a/../../b", "a//b", "a//", "//h", "//h/../x", ";p", "x;p?q", "?", "?a",
        "https:x", "https:/x", "https:", "http:x", "tel:1", "javascript:void(0)", "a:b", "x?y=/../z",
        "\n/x", "x\ty", "",
    ]
    bases = [
        "https://e.com", "https://e.com/", "https://e.com/a", "https://e.com/a/b/", "https://e.com/a//b/c",
        "https://e.com/a;p/b;q?r=1", "https://e.com?x=1", "http://e.com/a/../b/c",
    ]
    pairs = [(b, h) for b in bases for h in hrefs] + [(b, h) for b, h, _ in JOINS]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, b string, h string")
    rows = df.select("i", urls.resolve(F.col("b"), F.col("h")).alias("o")).orderBy("i").collect()
    got = [r.o for r in rows]
    want = [
        h if h.startswith(("http://", "https://")) else urllib.parse.urljoin(b, h) for b, h in pairs
    ]
    assert [(p, w) for p, w in zip(pairs, want)] == [(p, g) for p, g in zip(pairs, got)]
    assert got[-len(JOINS):] == [w for _, _, w in JOINS]


def test_extension_list(spark):
    assert run(spark, urls.extension_list, [".jpg, png,, .JPG ", ""]) == [[".jpg", ".png", ".JPG"], []]


@pytest.mark.parametrize("url,want", [
    ("https://e.com", "/"),
    ("https://e.com/a%20b+c?x=%2F#f", "/a b+c?x=/#f"),
    ("https://e.com/a;p?", "/a;p"),
    ("https://e.com/%zz", "/%zz"),
    ("https://e.com/a%23b", "/a#b"),
])
def test_robots_path(spark, url, want):
    assert run(spark, urls.robots_path, [url]) == [want]
