"""robots rules against the standard library's reader on random files."""

import random
import urllib.robotparser

import pytest
from pyspark.sql import functions as F

from webtide.operators import robots as R
from webtide.sources.robots_files import pick_robots

AGENT = "WebtideBot/1.0"
WORDS = ["/", "/a", "/a/b", "/b?", "/b?x=1", "/%61", "/c%2Fd", "*", "", "/a#", "/a#f", "/d+e", "/ü", "/a;p", "/%zz"]
AGENTS = ["*", "webtidebot", "WebtideBot", "web", "other", "", "webtidebot/2"]


def random_file(rng: random.Random) -> str:
    out = []
    for _ in range(rng.randint(0, 12)):
        kind = rng.random()
        if kind < 0.3:
            out.append(f"User-agent: {rng.choice(AGENTS)}")
        elif kind < 0.7:
            out.append(f"{rng.choice(['Allow', 'Disallow', 'disallow ', 'ALLOW'])}: {rng.choice(WORDS)}")
        else:
            out.append(rng.choice(["", "   ", "# note", "Crawl-delay: 3", "Request-rate: 1/5", "Sitemap: /s", "junk", "Foo: /"]))
    return rng.choice(["\n", "\r\n"]).join(out)


def test_gate_equals_standard_reader(spark):
    rng = random.Random(7)
    files = [(f"h{i}.example.com", random_file(rng)) for i in range(400)]
    paths = ["", "/", "/a", "/a/b/c", "/b", "/b?x=1", "/b?", "/c/d", "/c%2Fd", "/d+e", "/d%2Be", "/ü", "/%C3%BC", "/a;p?q", "/a#f", "/*", "/%zz"]
    asked = [(d, f"https://{d}{p}") for d, _ in files for p in paths]
    rules = R.rule_tables(R.directive_lines(spark.createDataFrame(files, "domain string, text string")), AGENT)
    rows = R.gate(spark.createDataFrame(asked, "domain string, url string"), rules).collect()
    got = {r.url: r.allowed for r in rows}
    readers = {}
    for domain, text in files:
        reader = urllib.robotparser.RobotFileParser()
        reader.parse(text.splitlines())
        readers[domain] = reader
    wrong = [
        (u, got[u], dict(files)[d]) for d, u in asked if got[u] != readers[d].can_fetch(AGENT, u)
    ]
    assert not wrong, wrong[:3]


def test_gate_off(spark):
    urls = spark.createDataFrame([("https://e.com/x",)], "url string")
    assert R.gate(urls, None, follow=False).first().allowed


@pytest.mark.parametrize("text,want", [
    ("User-agent: *\nCrawl-delay: 2", 2.0),
    ("User-agent: *\nCrawl-delay: 2\nUser-agent: webtidebot\nCrawl-delay: 5", 5.0),
    ("User-agent: webtidebot\nUser-agent: *\nCrawl-delay: 5", 5.0),
    ("User-agent: webtidebot\nCrawl-delay: 5\nCrawl-delay: 6\nUser-agent: *\nCrawl-delay: 1", 6.0),
    ("User-agent: nobody\nCrawl-delay: 5", None),
    ("Crawl-delay: 5", None),
    ("User-agent: *\n\n# c\nCrawl-delay: x\nCrawl-delay: 1.5", 1.5),
    ("User-agent: *\nSitemap: /s\nUser-agent: nobody\nCrawl-delay: 3", None),
    ("User-agent:\nCrawl-delay: 3", 3.0),
])
def test_crawl_delay(spark, text, want):
    lines = R.directive_lines(spark.createDataFrame([("e.com", text)], "domain string, text string"))
    row = R.crawl_delays(lines, AGENT).first()
    assert (row.crawl_delay if row else None) == want


def test_pick_robots(spark):
    rows = [
        ("a", "https", 200, "A"), ("a", "http", 200, "B"), ("b", "https", 404, "A"), ("b", "http", 200, "B"),
        ("c", "https", 500, "A"), ("d", "ftp", 200, "X"),
    ]
    df = spark.createDataFrame(rows, "domain string, proto string, status int, text string")
    assert sorted(map(tuple, pick_robots(df).collect())) == [("a", "A"), ("b", "B")]


def test_refresh_longest_prefix(spark):
    text = "# refresh: /a 10\n# refresh: /a/b 20\n#refresh: /a 30\n# Refresh: /c 1\n# refresh: /d x"
    hints = R.refresh_hints(R.directive_lines(spark.createDataFrame([("e.com", text)], "domain string, text string")))
    urls = spark.createDataFrame([(f"https://www.e.com{p}",) for p in ("/a", "/a/b/c", "/c", "")], "url string")
    got = {r.url: r.refresh_s for r in R.refresh_intervals(urls, hints).collect()}
    assert list(got[f"https://www.e.com{p}"] for p in ("/a", "/a/b/c", "/c", "")) == [30, 20, None, None]
